"""Small hand-made pages on which the extraction model is trained.

Elements marked ``data-main`` hold main text and those marked ``data-not``
inside them do not; all other text is not main text. The marks are read for
labels only and are no features.
"""

_S = "The committee met on Tuesday to discuss the new plan, and most members agreed that the old bridge should be repaired first. "
_T = "Work will begin in spring, according to the mayor, who said that the cost had been kept low. "
_U = "Residents have waited for years; some of them had given up hope."
_SHORT = "A short closing line."
_LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Sport", "Contact", "About us", "Archive"))
_MORE = "".join(f'<li><a href="/s/{i}">{t}</a></li>' for i, t in enumerate(
    ("Storm closes the harbour road", "Ten ways to save water", "School wins the cup again", "Council votes on budget")))

PAGES = [
    f"""<html><head><title>Bridge</title></head><body><nav><ul>{_LINKS}</ul></nav><div class="ad">Buy two shoes and get one free.</div>
    <article data-main><h1>Bridge to be repaired</h1><p><b>{_T}<br><p>{_S}{_T}</p><p>{_U}</p><p>{_S}</p><p>{_SHORT}</p></article>
    <footer>&copy; example.org &middot; All rights reserved here.</footer></body></html>""",
    f"""<html><body><header><a href="/">The Daily</a><p>Independent since 1901</p></header><nav><a href="/a">World</a> <a href="/b">Local</a></nav>
    <main><article data-main><header><h1>Plan agreed</h1></header><p>{_S}{_S}</p><h2>What comes next</h2><p>{_T}</p><ul><li>{_U}</li><li>Free parking stays.</li></ul>
    <blockquote><p>{_T}</p></blockquote><p>{_SHORT}</p></article>
    <aside><h3>Related</h3><ul>{_MORE}</ul></aside></main>
    <section id="comments"><h3>3 comments</h3><div class="comment"><p>Anna wrote: I do not believe a word of it, they said the same last year and nothing happened.</p></div>
    <div class="comment"><p>{_U} Thank you for the report.</p></div></section><footer><p>Imprint and privacy policy of the newspaper.</p></footer></body></html>""",
    f"""<html><body><div id="header"><div class="logo">Garden blog</div><div class="menu"><ul>{_LINKS}</ul></div></div>
    <div id="wrapper"><div id="content"><div class="post" data-main><h2 class="title">Planting beans</h2><div class="entry"><p>{_S}</p><p>{_T}{_U}</p><p>{_S}{_T}</p>
    <div class="share" data-not><a href="#">Tweet</a> <a href="#">Share</a></div></div></div>
    <div class="comments"><h3>Responses</h3><ol><li class="comment"><p>{_T} Great post, I will try this in my own garden next week.</p></li></ol><form><label>Your name</label><p>Leave a reply below.</p></form></div></div>
    <div id="sidebar"><div class="widget"><h4>Archives</h4><ul>{_MORE}</ul></div><div class="widget"><p>Subscribe to our letter and never miss a post again.</p></div></div></div>
    <div id="footer"><p>Powered by beans. Copyright by the author of this blog.</p></div></body></html>""",
    f"""<html><body><div class="cookie-notice banner"><p>We use cookies to give you the best experience on our website. By going on you accept them.</p><button>Accept</button></div>
    <div class="navbar"><a href="/">Start</a><a href="/docs">Docs</a></div><div class="container"><div class="row"><div class="sidebar col"><ul>{_MORE}</ul><p>Need help? Write to our support team at any time of the day.</p></div>
    <div class="article-body col" data-main><h1>Install</h1><p>{_T}</p><pre>make all
make install</pre><p>{_S}</p><table><tr><th>Name</th><th>Size</th></tr><tr><td>small</td><td>10 boxes</td></tr></table><p>{_U}</p></div></div></div>
    <div class="newsletter"><form><p>Sign up for our newsletter to get the latest news every week.</p><input type="text"></form></div>
    <div class="site-footer"><p>Terms of use. Contact us.</p></div></body></html>""",
    f"""<html><body><div class="breadcrumbs"><a href="/">Home</a> &gt; <a href="/n">News</a></div><div class="main-content"><div class="headline" data-main><h1>Harbour road</h1></div>
    <div class="byline meta">By A. Writer, 3 May</div><div class="story" data-main><p>{_S}{_U}</p><div class="advertisement" data-not><p>Advertisement: the best shoes in town are at our shop, come and see them today.</p></div>
    <p>{_T}{_S}</p><figure data-not><figcaption>The road in winter.</figcaption></figure><p>{_U}{_T}</p></div>
    <div class="related-articles"><h3>Read more</h3><ul>{_MORE}</ul></div><div class="promo sponsored"><p>Sponsored: save money on your next holiday with this one offer, only this week.</p></div></div>
    <div class="popup modal"><p>Do not leave yet! Get ten percent off your first order with us today.</p></div></body></html>""",
    f"""<html><body><table><tr><td><a href="/">Index</a><br><a href="/2">Page two</a></td><td data-main><h1>Old page</h1><p>{_S}</p><p>{_T}</p>
    <p>{_U} See <a href="/x">the plan</a> for more.</p></td></tr></table><hr><address>Webmaster, last changed in 1999.</address></body></html>""",
    f"""<html><body><div role="navigation"><ul>{_LINKS}</ul></div><div role="main"><div class="text" data-main><h1>Water</h1><div>{_S}{_T}</div><div>{_T}{_U}</div><ol><li>{_T}</li><li>{_S}</li></ol></div>
    <div class="author-box"><p>The author lives near the sea and writes about water and boats.</p></div><div class="tags"><a href="/t">water</a> <a href="/u">sea</a></div></div>
    <div role="complementary"><p>Most read stories of this week in our paper.</p><ul>{_MORE}</ul></div><div role="contentinfo">All rights reserved.</div>
    <div class="alert notice"><p>Our site will be down for service on Sunday night from ten to twelve.</p></div></body></html>""",
    f"""<html><body><nav class="menu"><ul>{_LINKS}</ul></nav><section class="content"><article data-main><h1>Short note</h1><p>{_SHORT}</p><p>Yes.</p><p>{_U}</p></article>
    <div class="reader-comments"><p>{_S} That is what I told my neighbour as well.</p><p>{_T}</p></div></section>
    <aside class="sidebar"><p>{_T} Read our weekly column in the paper.</p></aside><footer>Footer text of the site &middot; {_U}</footer></body></html>""",
    f"""<html><body><header class="site-header"><h1>My site</h1><p>Notes about everything and nothing, written slowly.</p></header><main data-main><h1>On walking</h1><p>{_S}</p><p>{_T}</p><p>{_S}{_U}</p></main>
    <div id="disqus_thread" class="discussion"><p>{_U} I walk every day as well, and so does my dog.</p></div><form action="/search"><p>Search this site for a word.</p></form></body></html>""",
]

# Names that page authors give to boxes beside the main text, and to the main text.
BESIDE = (
    "ad ads advert advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert "
    "popup modal overlay newsletter subscribe signup share sharing social comments comment commentlist respond replies reply "
    "disqus discussion reactions related recommended popular trending sidebar side widget rail menu nav navbar navigation topbar "
    "breadcrumb breadcrumbs pagination pager footer foot bottom header masthead logo toolbar login search copyright legal "
    "disclaimer tags author bio teaser outbrain taboola skip").split()
MAIN = "article post entry content story text body main page prose markdown posttext article-text post-content".split()
_LINES = (_U, _SHORT, f"{_T}{_U}", "Click here to see more.", f"{_S}{_T}")


def _variants():
    for i, name in enumerate(BESIDE):
        main, line = MAIN[i % len(MAIN)], _LINES[i % len(_LINES)]
        box = f'<div class="{name}"><p>{line}</p></div>' if i % 3 else f'<div id="{name}">{line}<ul>{_MORE}</ul></div>'
        body = f'<div class="{main}" data-main><h1>Title of the page</h1><p>{_S}</p><p>{_SHORT}</p><p>{_T}{_U}</p></div>'
        if i % 4 == 1:
            body = body.replace(f"<p>{_SHORT}</p>", f"<ul><li>{_U}</li><li>{_SHORT}</li></ul><ol><li>{_T}</li></ol>")
        if i % 8 == 3:
            body = body.replace(f"<p>{_SHORT}</p>", f"<table><tr><td>Name</td><td>10 boxes</td></tr></table><div>{_T}</div>")
        if i % 2:
            body = body.replace("<div", "<article", 1).replace("</div>", "</article>")
        parts = (body, box) if i % 4 < 2 else (box, body)
        top = "<header><h1>The site</h1><p>All about it.</p></header>" if i % 3 == 1 else ""
        yield f'<html><body>{top}<div class="wrapper">{parts[0]}{parts[1]}</div><footer><p>{_SHORT}</p></footer></body></html>'
        if i % 5 == 0:
            yield body.replace(f"<p>{_SHORT}</p>", box.replace("<div", "<div data-not", 1)).join(("<html><body>", "</body></html>"))


PAGES += list(_variants())
PAGES += [
    f"<html><body data-main><h1>Plain page</h1><p>{_S}</p><p>{_T}{_U}</p></body></html>",
    f"<html><body data-main><p>{_T}</p><p>{_S}</p><p>{_SHORT}</p></body></html>",
    f"<html><body><nav>{_MORE}</nav><div data-main><p>{_T}</p><p>{_S}</p></div><footer>{_SHORT}</footer></body></html>",
    f"<html><body><header>{_LINKS}</header><div data-main><h1>Title</h1><p>{_T}</p><p>{_S}{_S}</p></div></body></html>",
]
