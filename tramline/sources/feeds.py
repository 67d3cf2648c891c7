"""Landed feeds as batch or streaming frames.

The feeds arrive as files of one JSON document per line, or on a Kafka topic
where the connector is installed. Every reader takes an explicit schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions import codes
from tramline.operators.shape import stack
from tramline.schemas import DOCUMENTS

# The routes of the combined pull.
MAJOR_ROUTES = ("Red", "Orange", "Blue", "Green-B", "Green-C", "Green-D", "Green-E")

CORRUPT = "_corrupt_record"


def text_lines(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """Lines with their ``position``: the time and name of the file, and where in it a task begins to read."""
    reader = spark.readStream if streaming else spark.read
    return reader.options(**options).text(path).select("value", F.struct(
        F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("name"),
        F.col("_metadata.file_block_start").alias("block")).alias("position"))


def kafka_lines(
    spark: SparkSession, servers: str, topics: list[str], streaming: bool = True, **options: str,
) -> DataFrame:
    """Message values of Kafka topics, from the earliest offset unless told otherwise."""
    reader = spark.readStream if streaming else spark.read
    settings = {
        "kafka.bootstrap.servers": servers, "subscribe": ",".join(topics),
        "startingOffsets": "earliest", **options}
    return reader.format("kafka").options(**settings).load().select(
        F.col("value").cast("string").alias("value"), "topic", F.col("key").cast("string").alias("key"),
        F.struct("timestamp", "partition", "offset").alias("position"))


def decode(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON text in ``value`` as a struct column ``doc``; text that fails keeps itself in ``corrupt``.

    The text goes along as ``raw``, and its ``position`` where it has one.

    The document goes through a one-element explode: as a plain column it would
    be parsed again in each filter that Spark moves below it.
    """
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    doc = F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    place = [c for c in ("position",) if c in lines.columns]
    parsed = lines.select("value", *place, F.explode(F.array(doc)).alias("doc"))
    bad = F.col("doc").isNull() | F.col(f"doc.{CORRUPT}").isNotNull()
    return parsed.select("doc", F.when(bad, F.col("value")).alias("corrupt"), F.col("value").alias("raw"), *place)


def documents(decoded: DataFrame) -> DataFrame:
    """The fields of the documents that could be read; a response document gives those in its ``data``."""
    names = [n for n in decoded.schema["doc"].dataType.names if n not in (CORRUPT, "data")]
    along = [c for c in ("raw", "position") if c in decoded.columns]
    good = decoded.where("corrupt IS NULL")
    if "data" not in decoded.schema["doc"].dataType.names:
        return good.select(*[F.col(f"doc.{n}").alias(n) for n in names], *along)
    alone = F.array(F.struct(*[F.col(f"doc.{n}").alias(n) for n in names]))
    return good.select(F.explode(F.coalesce("doc.data", alone)).alias("doc"), *along).select("doc.*", *along)


def undecodable(decoded: DataFrame) -> DataFrame:
    return decoded.where("corrupt IS NOT NULL").select("corrupt")


def _any_of(df: DataFrame, column: str, values) -> DataFrame:
    return df if not values else df.where(F.col(column).isin(*values))


def pick_predictions(raw: DataFrame, route_ids=None, stop_ids=None) -> DataFrame:
    kept = _any_of(raw.where("type = 'prediction'"), "relationships.route.data.id", route_ids)
    return _any_of(kept, "relationships.stop.data.id", stop_ids)


def pick_vehicles(raw: DataFrame, route_ids=None) -> DataFrame:
    return _any_of(raw.where("type = 'vehicle'"), "relationships.route.data.id", route_ids)


def pick_routes(raw: DataFrame, route_types=None) -> DataFrame:
    return _any_of(raw.where("type = 'route'"), "attributes.type", route_types)


def combined_pull(raw: DataFrame, route_ids=MAJOR_ROUTES) -> DataFrame:
    """Predictions and vehicles of the major routes from one mixed feed."""
    return stack(pick_predictions(raw, route_ids), pick_vehicles(raw, route_ids))


def rest_records(lines: DataFrame) -> DataFrame:
    return documents(decode(lines, DOCUMENTS["rest"])).drop("raw", "position")


def feed_messages(lines: DataFrame) -> DataFrame:
    return documents(decode(lines, DOCUMENTS["feed"])).drop("raw", "position")


def generic_messages(lines: DataFrame, schema: str, enums: dict[str, dict[int, str]] = codes.MESSAGE_ENUMS) -> DataFrame:
    """Landed nested messages of any ``schema`` (DDL), their enum codes as names; a line that is no message has only nulls."""
    read = lines.select(F.from_json("value", schema).alias("doc"))
    kind = read.schema["doc"].dataType
    return read.select(*[codes.with_names(F.col("doc")[f.name], f.dataType, enums, f.name).alias(f.name) for f in kind])


def protobuf_messages(blobs: DataFrame, descriptor: str, message: str = "transit_realtime.FeedMessage") -> DataFrame:
    """Binary feed files (column ``content``) as feed messages, where the protobuf module is installed."""
    from pyspark.sql.protobuf.functions import from_protobuf

    return blobs.select(from_protobuf(
        "content", message, descriptor, {"enums.as.ints": "false"}).alias("doc")).select("doc.*")
