"""Hand-made pages (none comes from the generator the labeller learns from) with the text that is to be extracted."""

from __future__ import annotations

A = "The river rose in the night, and the mill stood still as it had in the years before."
B = "Nobody came to the bridge that morning, although the bells had been rung twice."
C = "In the spring the council met again and agreed that a new weir should be built above the town."
D = "Work began in May, under an engineer from the coast, and it lasted three summers."
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About</a></li></ul></nav>'
MENU = '<div class="menu"><ul><li><a href="/">Home</a></li><li><a href="/town">Town</a></li><li><a href="/maps">Maps</a></li></ul></div>'
FOOT = "<footer><p>&copy; 2021 The Gazette. All rights reserved.</p></footer>"
P = lambda *t: "".join(f"<p>{x}</p>" for x in t)
COOKIE = '<div class="cookie-notice"><p>We use cookies to make this site work better for you.</p></div>'

#: name: (page, the blocks of its main text)
LAYOUTS: dict[str, tuple[str, list[str]]] = {
    "bare paragraphs": (f"<html><body>{P(A, B)}</body></html>", [A, B]),
    "notice inside the only div": (f"<div>{COOKIE}{P(A, B)}</div>", [A, B]),
    "notice before a post": (f'<body>{COOKIE}<div class="post">{P(A, B)}</div></body>', [A, B]),
    "notice before bare paragraphs": (f"<body>{COOKIE}{P(A, B)}</body>", [A, B]),
    "notice before an article": (f"<body>{COOKIE}<article>{P(A, B)}</article></body>", [A, B]),
    "notice, menu, post": (f'<body>{COOKIE}{MENU}<div class="post"><h1>The weir</h1>{P(A, B, C)}</div>{FOOT}</body>', ["The weir", A, B, C]),
    "short paragraph first": (f'<body><div class="post"><p>Yes.</p><p>{A}</p><table><tr><td>1901</td><td>mill</td></tr></table></div></body>', ["Yes.", A, "1901", "mill"]),
    "short paragraph between": (f"<body>{NAV}<main><h1>The weir</h1>{P(A, 'No.', B)}</main>{FOOT}</body>", ["The weir", A, "No.", B]),
    "short paragraph last": (f'<body>{MENU}<div class="content">{P(A, B, C, "So it was.")}</div>{FOOT}</body>', [A, B, C, "So it was."]),
    "one paragraph": (f"<body>{NAV}<div><p>{A}</p></div>{FOOT}</body>", [A]),
    "one heading, one paragraph": (f'<body>{NAV}<div class="entry"><h2>Floods</h2><p>{A}</p></div>{FOOT}</body>', ["Floods", A]),
    "div comments": (f'<body><div class="post"><h1>The weir</h1>{P(A, B)}</div><div class="comments"><h3>2 comments</h3><div>What a fine story, I was there.</div><div>My mother remembers the mill very well.</div></div></body>', ["The weir", A, B]),
    "comments in articles": (f'<body><article><h1>Floods</h1>{P(A, C)}</article><section id="comments"><article class="comment"><p>I like this.</p></article><article class="comment"><p>So do I, very much indeed.</p></article></section></body>', ["Floods", A, C]),
    "printed footer": (f'<body><div id="content"><h1>Floods</h1>{P(A, B, C)}</div><div class="printfooter">Retrieved from the town archive</div></body>', ["Floods", A, B, C]),
    "share line": (f'<body>{NAV}<article>{P(A, B)}</article><div class="share">Share this: <a href="/m">Mail</a></div>{FOOT}</body>', [A, B]),
    "layout table": (f'<body><table><tr><td class="nav"><a href="/">Home</a></td><td class="content">{P(A, B)}</td></tr><tr><td class="footer">Copyright the town press</td></tr></table></body>', [A, B]),
    "sidebar first": (f'<body><div class="sidebar"><h3>Related</h3><ul><li><a href="/1">Mills</a></li><li><a href="/2">Weirs</a></li></ul></div><div id="main">{P(A, B, C)}</div></body>', [A, B, C]),
    "sidebar prose": (f'<body><article><h1>Floods</h1>{P(A, B)}</article><aside><p>The Gazette has been the paper of the valley since 1840.</p></aside></body>', ["Floods", A, B]),
    "advert inside": (f'<body><article><p>{A}</p><div class="ad">Buy boots now, half price until Sunday.</div><p>{B}</p></article></body>', [A, B]),
    "sponsored section": (f'<body>{MENU}<div class="article"><p>{A}</p><p>{C}</p></div><div class="sponsored"><p>Our partners have new offers for your garden.</p></div>{FOOT}</body>', [A, C]),
    "login form": (f'<body><form action="/login"><p>Sign in to read more</p><input name="u"><button>Go</button></form><article>{P(A, B)}</article></body>', [A, B]),
    "newsletter last": (f'<body><main>{P(A, B, C)}</main><div class="newsletter"><p>Get our letter every week. No charge.</p></div></body>', [A, B, C]),
    "header with tagline": (f'<body><header><h1>The Gazette</h1><p>News of the valley since 1840.</p></header><main><h2>Floods</h2>{P(A, B)}</main>{FOOT}</body>', ["Floods", A, B]),
    "lists in the article": (f"<body>{NAV}<article><h1>The weir</h1><p>{A}</p><ul><li>oak</li><li>iron</li><li>stone from the old quarry</li></ul></article>{FOOT}</body>", ["The weir", A, "oak", "iron", "stone from the old quarry"]),
    "quotation": (f'<body><div class="post-body"><p>{A}</p><blockquote><p>{B}</p></blockquote><p>{C}</p></div>{FOOT}</body>', [A, B, C]),
    "breadcrumbs": (f'<body><div class="breadcrumb"><a href="/">Home</a> &gt; <a href="/t">Town</a></div><article><h1>Floods</h1>{P(A, B)}</article></body>', ["Floods", A, B]),
    "pager": (f'<body><article>{P(A, B)}</article><div class="pagination"><a href="/1">Previous</a> <a href="/3">Next</a></div>{FOOT}</body>', [A, B]),
    "plain divs": (f"<body><div>{MENU}<div><div>{A}</div><div>{B}</div><div>{C}</div></div></div></body>", [A, B, C]),
    "old tags": (f"<HTML><BODY><CENTER><H1>The weir</H1></CENTER><P>{A}<P>{B}<P>{C}</BODY></HTML>", ["The weir", A, B, C]),
    "figure": (f'<body>{NAV}<article><p>{A}</p><figure><img src="x.png"><figcaption>The mill in 1901.</figcaption></figure><p>{D}</p></article>{FOOT}</body>', [A, "The mill in 1901.", D]),
    "consent dialog": (f'<body><div role="dialog"><p>Please accept our terms before you go on.</p><button>Accept</button></div><div role="main"><h1>Floods</h1>{P(A, B)}</div></body>', ["Floods", A, B]),
    "notice in the article": (f'<body>{NAV}<article><h1>Floods</h1><div class="notice"><p>This page was moved from the old site.</p></div>{P(A, B, D)}</article>{FOOT}</body>', ["Floods", A, B, D]),
    "two columns": (f'<body>{MENU}<div class="container"><div class="content"><h1>Floods</h1>{P(A, B, C)}</div><div class="sidebar"><p>Popular this week</p><ul><li><a href="/a">Weirs</a></li></ul></div></div>{FOOT}</body>', ["Floods", A, B, C]),
    "six paragraphs": (f'<body>{COOKIE}{MENU}<div class="post">{P(A, B, C, D, A, B)}</div>{FOOT}</body>', [A, B, C, D, A, B]),
    "copyright after prose": (f'<body><div>{P(A, B)}</div><div class="copyright">Copyright 1999 by the town press. All rights reserved.</div></body>', [A, B]),
    "definitions": (f"<body>{NAV}<main><h1>Words</h1><p>{A}</p><dl><dt>weir</dt><dd>a low dam across a river</dd></dl></main>{FOOT}</body>", ["Words", A, "weir", "a low dam across a river"]),
    "references": (f'<body>{NAV}<article><h1>Floods</h1>{P(A, C)}<h2>Notes</h2><ol><li>Town archive, 1901.</li></ol></article>{FOOT}</body>', ["Floods", A, C, "Notes", "Town archive, 1901."]),
    "no prose": (f"<body>{NAV}{FOOT}</body>", []),
    "tags after the post": (f'<body><div class="post"><h1>Floods</h1>{P(A, B)}<div class="tags"><a href="/t/river">river</a> <a href="/t/mill">mill</a></div></div>{FOOT}</body>', ["Floods", A, B]),
    "long menu": ("<body><div id=nav><ul>" + "".join(f'<li><a href="/{i}">Place {i}</a></li>' for i in range(25)) + f'</ul></div><div id=text><h1>Floods</h1>{P(A, B)}</div></body>', ["Floods", A, B]),
}

#: Written after the first changes of the generator (then 8 of 10 were right; `section` around an article was added since).
LAYOUTS |= {
    "later: banner, then a section": (f'<body><div id="gdpr-banner"><p>We and our partners store data on your device.</p><button>OK</button></div><section><h2>Ice</h2>{P(B, D)}</section></body>', ["Ice", B, D]),
    "later: one div paragraph": (f"<body>{MENU}<div><h1>Ice</h1><div>{D}</div></div>{FOOT}</body>", ["Ice", D]),
    "later: subscribe box between": (f'<body>{NAV}<div class="story"><p>{B}</p><div class="subscribe"><p>Subscribe for only two pounds a month.</p></div><p>{D}</p></div>{FOOT}</body>', [B, D]),
    "later: related posts": (f'<body><article><h1>Ice</h1>{P(D, C)}</article><div class="related"><h3>More from the valley</h3><div><a href="/a">Hay</a></div><div><a href="/b">Corn</a></div></div>{FOOT}</body>', ["Ice", D, C]),
    "later: three short lines": (f"<body>{NAV}<main><p>Snow fell.</p><p>It froze.</p><p>{C}</p></main>{FOOT}</body>", ["Snow fell.", "It froze.", C]),
    "later: search form and footer": (f'<body><form class="search"><input name="q"><button>Find</button></form><div id="article"><h1>Ice</h1>{P(C)}</div><div id="footer"><p>Printed in the valley.</p></div></body>', ["Ice", C]),
    "later: replies": (f'<body><div class="content"><h1>Ice</h1>{P(B, C, D)}</div><div id="replies"><div class="reply"><p>Thank you for this.</p></div><div class="reply"><p>The ice was a foot thick at our farm.</p></div></div></body>', ["Ice", B, C, D]),
    "later: alert and header": (f'<body><header><div class="logo">Valley Post</div></header><div class="alert"><p>Our office is closed on Monday.</p></div><article>{P(C, D)}</article>{FOOT}</body>', [C, D]),
    "later: table of years": (f"<body>{NAV}<article><h1>Ice</h1><p>{D}</p><table><tr><th>Year</th><th>Days</th></tr><tr><td>1901</td><td>12</td></tr></table></article>{FOOT}</body>", ["Ice", D, "Year", "Days", "1901", "12"]),
    "later: bare text": (f"<body>{A} {B}<br>{C}</body>", [f"{A} {B} {C}"]),
}
