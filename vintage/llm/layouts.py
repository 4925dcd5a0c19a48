"""Labelled pages: layouts whose content elements are marked, filled with made-up text."""

from __future__ import annotations

import random

#: Each layout marks what is content with data-main, and what is not within it with data-not.
#: {t}: sentences, {s}: a few words, {l}: items with links.
LAYOUTS = [
    '<body><nav><ul>{l}</ul></nav><div class="ad">{t}</div><article data-main><h1>{s}</h1><p>{t}<p>{t}<p>{s}</p></article><footer>&copy; {s}</footer></body>',
    '<body><header><a href="/">{s}</a><nav>{l}</nav></header><main><article data-main><h1>{s}</h1><p>{t}</p><h2>{s}</h2><p>{t}</p><ul><li>{t}</li><li>{s}</li></ul><p>{t}</p></article><aside><h3>{s}</h3><ul>{l}</ul></aside></main><footer><p>{t}</p></footer></body>',
    '<body><div id="header"><h1>{s}</h1><div class="menu">{l}</div></div><div id="content" data-main><h2>{s}</h2><p>{t}</p><p>{t}</p><blockquote>{t}</blockquote><div class="share" data-not>{l}</div></div><div id="sidebar"><p>{t}</p>{l}</div><div id="footer">{s}</div></body>',
    '<body><div class="cookie-notice notice"><p>{t}</p><button>{s}</button></div><div class="top-bar">{l}</div><div class="post" data-main><h1 class="title">{s}</h1><div class="post-body"><p>{t}</p><p>{s}</p><p>{t}</p></div></div><section id="comments" class="comments"><h3>{s}</h3><div class="comment"><p>{t}</p></div><div class="comment"><p>{s}</p></div></section><div class="footer">{l}</div></body>',
    '<body><div class="wrapper"><div class="navbar"><ul>{l}</ul></div><div class="row"><div class="main-content" data-main><h1>{s}</h1><div>{t}</div><div>{t}</div><table><tr><td>{s}</td><td>{s}</td></tr></table></div><div class="col sidebar widget"><h4>{s}</h4><p>{t}</p></div></div></div><div class="site-footer"><p>{t}</p></div></body>',
    '<body><header class="site-header"><h2>{s}</h2></header><article data-main><header><h1>{s}</h1></header><p>{t}</p><p>{t}</p><aside class="related" data-not><h3>{s}</h3>{l}</aside><p>{t}</p><form data-not><label>{s}</label><p>{s}</p></form><section class="comments" data-not><p>{t}</p><p>{s}</p></section></article><footer>{s}{l}</footer></body>',
    '<body><table><tr><td class="nav">{l}</td><td class="content" data-main><h1>{s}</h1><p>{t}<p>{t}</td><td class="ads sponsored"><p>{t}</p></td></tr></table><div class="copyright">{s}</div></body>',
    '<body><h1 data-main>{s}</h1><p data-main>{t}</p><p data-main>{t}</p><p data-main>{s}</p><hr><p class="footer">{s}</p></body>',
    '<body><div role="banner">{s}{l}</div><div role="navigation">{l}</div><div role="main" data-main><h1>{s}</h1><p>{t}</p><pre>{t}</pre><dl><dt>{s}</dt><dd>{t}</dd></dl></div><div role="complementary"><p>{t}</p></div><div role="contentinfo">{s}</div></body>',
    '<body><div class="alert notice"><p>{s}</p></div><div class="breadcrumb">{l}</div><main data-main><section><h2>{s}</h2><p>{t}</p></section><section><h2>{s}</h2><p>{t}</p><figure><figcaption>{s}</figcaption></figure></section></main><div class="newsletter signup"><form><p>{t}</p></form></div><div class="pagination">{l}</div><footer class="footer">{l}<p>{s}</p></footer></body>',
    '<body><div class="advert banner"><p>{t}</p></div><div class="entry" data-main><h1>{s}</h1><p>{t}</p><div class="ad" data-not>{t}</div><p>{t}</p><div class="advertisement promo" data-not><p>{s}</p></div><p>{s}</p></div><ol class="comment-list"><li>{t}</li><li>{s}</li></ol><div class="menu footer-menu">{l}</div></body>',
    '<body><div id="page"><div id="masthead">{s}</div><div id="text" class="story article-body" data-main><p>{t}</p><p>{t}</p><p>{s}</p><ul><li>{s}</li><li>{t}</li></ul></div><div class="popup modal consent"><p>{t}</p></div><div id="disqus_thread" class="discussion replies"><p>{t}</p></div></div></body>',
]


def _filled(layout: str, rng: random.Random) -> str:
    def words(least: int, most: int) -> str:
        return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(least, most)))

    def fill(mark: str) -> str:
        if mark == "t":
            return " ".join(words(3, 25).capitalize() + "." for _ in range(rng.randint(1, 8)))
        if mark == "s":
            return words(1, 7)
        return "".join(f'<li><a href="/{words(1, 1)}">{words(1, 3)}</a></li>' for _ in range(rng.randint(2, 8)))

    out = layout
    for mark in "tsl":
        while "{" + mark + "}" in out:
            out = out.replace("{" + mark + "}", fill(mark), 1)
    return out


def labelled_pages(each: int = 25, seed: int = 5) -> list[str]:
    """Every layout, filled so many times."""
    rng = random.Random(seed)
    return [_filled(layout, rng) for layout in LAYOUTS for _ in range(each)]
