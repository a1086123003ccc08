"""Labelled layouts: pages in common structures, each with ``data-label="1"`` on its content and ``"0"`` elsewhere."""

from __future__ import annotations

import random
from collections.abc import Iterator

#: A number in braces stands for so many words.
LAYOUTS = (
    """<html><head><title>{6}</title></head><body data-label="0"><div id="header" class="site-header"><a href="/">{2}</a>
    <div class="tagline">{6}</div></div><div id="menu" class="menu navbar"><ul><li><a>{1}</a></li><li><a>{2}</a></li></ul></div>
    <div id="cookie-notice" class="cookie-banner consent"><p>{14}</p><button>{1}</button></div>
    <div id="content" class="post-content" data-label="1"><h1>{7}</h1><p>{60}</p><p>{45} <a href="x">{3}</a> {20}</p>
    <div class="ad advert" data-label="0"><p>{12}</p></div><h2>{4}</h2><p>{80}</p><ul><li>{9}</li><li>{7}</li></ul></div>
    <div class="sidebar"><h3>{2}</h3><p>{18}</p><ul><li><a>{4}</a></li><li><a>{5}</a></li></ul></div>
    <div id="comments" class="comments"><h3>{2}</h3><div class="comment"><p>{25}</p></div><div class="comment"><p>{40}</p></div></div>
    <div id="footer" class="footer"><p>{10}</p><a>{2}</a></div></body></html>""",
    """<body data-label="0"><header><h2>{3}</h2><p>{8}</p><nav><a>{1}</a> <a>{1}</a> <a>{2}</a></nav></header>
    <main data-label="1"><h1>{8}</h1><p>{50}</p><blockquote><p>{20}</p></blockquote><p>{70}</p>
    <form class="newsletter subscribe" data-label="0"><p>{10}</p><label>{2}</label><input></form><p>{30}</p>
    <aside class="related" data-label="0"><h4>{2}</h4><p>{20}</p><a>{5}</a></aside></main>
    <section class="comments" id="disqus"><h2>{2}</h2><p>{30}</p><p>{15}</p></section><footer><p>{12}</p></footer></body>""",
    """<body data-label="0"><nav class="menu"><ul><li><a>{2}</a></li><li><a>{1}</a></li></ul></nav><div class="notice alert"><p>{16}</p></div>
    <div class="layout"><aside class="sidebar widget"><p>{30}</p><ul><li><a>{3}</a></li></ul></aside>
    <article data-label="1"><header><h1>{6}</h1></header><section><p>{40}</p><p>{55}</p></section><figure><figcaption>{8}</figcaption></figure>
    <table><tr><td>{3}</td><td>{4}</td></tr></table><pre>{12}</pre><p>{35}</p><div class="share social" data-label="0"><a>{1}</a><a>{1}</a></div>
    <footer data-label="0"><p>{9}</p></footer></article></div>
    <div class="ads sponsored promo"><p>{20}</p></div><div class="copyright"><p>{9}</p></div></body>""",
    """<body data-label="0"><table><tr><td class="header banner"><a>{3}</a></td></tr><tr><td class="menu"><a>{1}</a><br><a>{2}</a></td>
    <td class="body text" data-label="1"><h1>{5}</h1><p>{65}</p><p>{30}</p><p>{48}</p></td></tr>
    <tr><td class="footer">{10}</td></tr></table></body>""",
    """<body data-label="0"><div class="topbar"><a>{2}</a><a>{1}</a></div><div class="entry" data-label="1"><h1>{6}</h1><div>{55}</div><div>{45}</div>
    <div>{60}</div></div><div class="popup modal"><p>{15}</p></div><form id="search"><p>{4}</p></form>
    <div class="replies responses"><div class="reply"><p>{35}</p></div><div class="reply"><p>{20}</p></div></div>
    <div class="legal disclaimer"><p>{25}</p></div><div class="breadcrumb"><a>{2}</a><a>{2}</a></div></body>""",
    """<body data-label="1"><h1>{5}</h1><p>{40}</p><p>{60}</p></body>""",
    """<body data-label="0"><div class="banner advertisement">{14}</div><article data-label="1"><h1>{5}</h1><p>{12}</p><p>{90}</p>
    <aside class="pullquote advert" data-label="0">{16}</aside><p>{60}</p><p>{6}</p>
    <ul><li><a>{4}</a></li><li><a>{6}</a></li></ul><p><a>{9}</a></p><section id="reader-comments" class="discussion" data-label="0"><h3>{2}</h3><p>{28}</p><ol><li>{22}</li><li>{30}</li></ol></section></article>
    <aside class="sidebar">{30}</aside><footer>{12}</footer></body>""",
    """<body data-label="0"><div role="navigation"><a>{1}</a><a>{2}</a></div><div role="banner">{8}</div><div role="main" data-label="1"><h1>{6}</h1>
    <p>{50}</p><h2>{3}</h2><p>{40}</p><ol><li><a>{5}</a></li><li><a>{3}</a></li></ol><dl><dt>{2}</dt><dd>{10}</dd></dl></div><div role="complementary">{25}</div><div role="contentinfo">{12}</div>
    <div class="gdpr privacy">{18}</div><div class="login signup"><form><p>{8}</p></form></div></body>""",
)


def pages(copies: int = 8, seed: int = 5) -> Iterator[str]:
    """Each layout some times over, with lengths from a half to twice those it states."""
    draw = random.Random(seed)
    for layout in LAYOUTS:
        for _ in range(copies):
            parts = layout.split("{")
            out = [parts[0]]
            for part in parts[1:]:
                n, _, rest = part.partition("}")
                out.append(" ".join(["word"] * max(1, round(int(n) * draw.uniform(0.5, 2)))) + rest)
            yield "".join(out)
