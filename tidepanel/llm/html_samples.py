"""Labelled pages that the extraction model is trained from.

Each layout is a template; `data-main` marks an element whose text is main text
(with all below it), `data-other` one below it that is not. The marks are read by
training only. Fillers are sentences of made-up words, so that the model learns
structure and not vocabulary.

Besides whole pages (`LAYOUTS`) there are parts: bodies, what stands above, beside
and below them. `layouts` puts every body into several pages of parts. `{@role}` is a
class or id drawn anew for every page from that role's `NAMES`, and often none
at all, so that no single name is needed to tell a part.
"""

from __future__ import annotations

import random
import re

SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi xo zu ar en is ol ur".split()

LAYOUTS = [
    """<html><head><title>{t}</title></head><body><nav><ul>{links}</ul></nav><div class="ad">{s}</div>
    <article data-main><h1>{t}</h1>{paras}</article><footer>&copy; {t} &middot; {s}</footer></body></html>""",
    """<html><body><header><a href="/">{t}</a><nav><ul>{links}</ul></nav></header><main data-main><h1>{t}</h1>
    {paras}<h2>{t}</h2><ul>{items}</ul>{paras}<blockquote><p>{p}</p></blockquote></main>
    <aside><h3>{t}</h3><ul>{links}</ul></aside><footer><p>{s}</p><ul>{links}</ul></footer></body></html>""",
    """<html><body><div id="header"><p>{s}</p></div><div class="menu"><ul>{links}</ul></div>
    <div id="content" data-main><h2>{t}</h2>{paras}<div class="advert" data-other><p>{p}</p></div>{paras}
    <table><tr><th>{w}</th><th>{w}</th></tr><tr><td>{w}</td><td>{w}</td></tr></table></div>
    <div class="sidebar"><h3>{t}</h3><p>{s}</p><ul>{links}</ul></div><div id="footer"><p>{s}</p></div></body></html>""",
    """<html><body><div class="cookie-notice"><p>{p}</p><button>{w}</button></div><article data-main>
    <header><h1>{t}</h1></header>{paras}<aside data-other class="related"><h4>{t}</h4><ul>{links}</ul></aside>
    <figure><figcaption>{s}</figcaption></figure><section><h2>{t}</h2>{paras}</section>
    <section class="comments" data-other><h3>{t}</h3><div class="comment"><p>{p}</p></div>
    <div class="comment"><p>{s}</p></div></section></article><footer>{s}</footer></body></html>""",
    """<html><body><nav>{s}</nav><form action="/s"><p>{w}</p><label>{w}</label><input></form>
    <article data-main>{paras}<pre>{p}</pre><ol>{items}</ol></article>
    <section id="comments"><h2>{t}</h2><ol class="comment-list"><li class="comment"><p>{p}</p><p>{s}</p></li>
    <li class="comment"><p>{p}</p></li></ol><form class="comment-form"><p>{w}</p></form></section>
    <div class="newsletter subscribe"><p>{s}</p></div><footer><p>&copy; {s}</p></footer></body></html>""",
    """<html><body><div class="banner ads sponsored"><p>{p}</p></div><div class="breadcrumbs"><a href="/">{w}</a></div>
    <div class="post"><div class="entry-content article-body" data-main>{paras}<h3>{t}</h3>{paras}</div>
    <div class="share social"><a href="/x">{w}</a> <a href="/y">{w}</a></div><div class="disqus comments"><p>{p}</p>
    <p>{s}</p></div></div><div class="promo popup notice"><p>{p}</p></div><div role="contentinfo" class="footer">
    <p>{p}</p></div></body></html>""",
    """<html><body><div role="navigation"><a href="/">{w}</a> <a href="/">{w}</a></div><div class="alert warning notice">
    {s}</div><div role="main" data-main><h1>{t}</h1><p>{w}</p>{paras}<dl><dt>{w}</dt><dd>{s}</dd></dl></div>
    <div role="complementary" class="widget"><p>{p}</p></div><div class="cookie-banner consent gdpr">{p}</div>
    <div class="copyright">&copy; {s}</div></body></html>""",
    """<html><body><header><p>{s}</p><h2>{t}</h2></header><article data-main><p>{w}</p><p>{w}</p>
    <div class="ad" data-other>{p}</div><p>{s}</p><p>{p}</p><nav data-other><ul>{links}</ul></nav>
    <form data-other><p>{s}</p></form><p>{p}</p></article><aside class="sidebar"><p>{p}</p><p>{p}</p></aside>
    <div class="comments"><p>{p}</p></div><footer><p>{p}</p><p>{p}</p></footer></body></html>""",
    """<html><body><nav><a href="/">{w}</a></nav><article data-main><h1>{t}</h1>{paras}<aside class="sidebar"
    data-other><p>{p}</p></aside><div class="cookie-banner" data-other>{s}</div><form data-other><p>{w}</p></form>
    <div class="share" data-other><a href="/">{w}</a></div><section class="comments" data-other><h2>{t}</h2><p>{p}</p>
    <p>{s}</p></section></article><footer>{w}</footer></body></html>""",
    """<html><body><div class="notice">{s}</div><main data-main><p>{s}</p></main><div id="comments"><div
    class="comment"><p>{s}</p></div></div><footer>{s}</footer></body></html>""",
    """<html><body><main><article data-main><h1>{t}</h1><div>{paras}</div><div class="related" data-other><ul>{links}
    </ul></div><div class="ad" data-other><p>{s}</p></div></article><aside><p>{p}</p></aside></main></body></html>""",
    """<p data-main>{p}</p><p data-main>{s}</p>""",
    """<html><body><h1 data-main>{t}</h1><p data-main>{w}</p><p data-main>{p}</p><footer>{s}</footer></body></html>""",
    """<html><body data-main>{p}</body></html>""",
]


# What authors commonly name the parts of a page
NAMES = {
    "main": "content main article post entry story hentry text page single prose blog-post article-body "
            "entry-content post-body document description",
    "top": "header topbar masthead banner top site-header page-header brand logo hero-nav",
    "menu": "menu nav navbar navigation main-menu topnav links tabs breadcrumbs toc sitenav",
    "side": "sidebar side widget widget-area rail right-col secondary related popular recent tags teaser",
    "foot": "footer bottom colophon site-info copyright page-footer legal imprint",
    "talk": "comments respond discussion replies responses disqus thread comment-list reply commentlist",
    "ad": "ad ads advert sponsored promo advertisement adslot",
    "note": "notice cookie consent gdpr alert popup newsletter subscribe modal announcement",
    "share": "share social sharing tools byline-links follow",
    "wrap": "wrapper container layout row inner outer wrap grid col box",
}
CERTAIN = ("talk", "ad", "note")  # prose that only its name tells from main text

BODIES = [
    "<article{@main} data-main><h1>{t}</h1>{paras}</article>",
    "<main{@main} data-main><h1>{t}</h1>{paras}<h2>{t}</h2>{paras}</main>",
    "<div{@main} data-main><h1>{t}</h1>{paras}<h2>{t}</h2><p>{p}</p>{paras}</div>",
    "<section data-main><h1>{t}</h1><p>{p}</p>{paras}</section>",
    "<div{@main}><h1 data-main>{t}</h1><div{@share}><a href='/x'>{w}</a> <a href='/y'>{w}</a></div>"
    "<div{@main} data-main><p>{p}</p>{paras}</div></div>",
    "<table><tr><td{@menu}><ul>{links}</ul></td><td><h1 data-main>{t}</h1>{own paras}</td></tr></table>",
    "<div{@wrap}><div{@menu}><ul>{links}</ul></div><div{@main} data-main><h1>{t}</h1><p>{p}</p><pre>{s}</pre>{paras}"
    "<table><tr><th>{w}</th><td>{w}</td></tr></table></div></div>",
    "<div{@main} data-main><h1>{t}</h1>{p}<br><br>{p}<br>{p}</div>",
    "<div{@main} data-main><h2>{t}</h2><div>{p}</div><div>{p}</div><div>{s}</div></div>",
    "<div{@wrap}><div{@wrap}><div{@main} data-main><div><h1>{t}</h1></div><div><p>{p}</p>{paras}</div></div></div></div>",
    "<div{@main}><h2 data-main>{t}</h2><div{@main} data-main><p>{p}</p>{paras}<blockquote><p>{s}</p></blockquote></div>"
    "<div{@share}><a href='/x'>{w}</a> <a href='/y'>{w}</a></div></div>",
    "<article{@main}><header data-main><h1>{t}</h1></header><div{@main} data-main><section><h2>{t}</h2>{paras}</section>"
    "<section><h2>{t}</h2><p>{p}</p>{paras}</section></div></article>",
    "<h1 data-main>{t}</h1>{own paras}<h2 data-main>{t}</h2>{own paras}",
    "<center data-main><h1>{t}</h1></center><blockquote data-main><p>{p}</p>{paras}</blockquote>",
    "<div{@main} data-main><h1>{t}</h1><p>{s}</p><ul>{items}</ul><p>{p}</p><ol>{items}</ol></div>",
    "<div{@main} data-main><h1>{t}</h1><figure><figcaption>{s}</figcaption></figure><p>{p}</p><p>{s}</p>{paras}"
    "<div{@ad} data-other><p>{s}</p></div><p>{p}</p></div>",
    "<section{@wrap}><section><h1 data-main>{t}</h1>{own paras}</section></section>",
    "{own paras}",
    "<p data-main>{p}</p><p data-main>{s}</p><p data-main>{s}</p>",
    "<h1 data-main>{t}</h1><p data-main>{w}</p><p data-main>{p}</p>",
    "<section><section data-main><p>{p}</p><p>{p}</p></section></section>",
    "<section{@wrap}><div data-main><h1>{t}</h1><p>{p}</p>{paras}</div></section>",
    "<main{@wrap}><section data-main><h2>{t}</h2><p>{p}</p></section><section data-main><h2>{t}</h2><p>{s}</p></section></main>",
    "<div data-main><b>{t}</b><br>{p}<br><br>{p}</div>",
    "<div{@main} data-main><h1>{t}</h1>{p}<p>{p}</p>{p}</div>",
    "<div{@main} data-main>{p}</div>",
    "<div><div data-main>{t}</div><div data-main>{p}</div><div data-main>{p}</div></div>",
    "<table><tr><td><div data-main><h1>{t}</h1>{p}<br>{p}</div></td></tr></table>",
    "<article{@main} data-main><p>{s}</p></article>",
    "<ul{@main}><li data-main><p>{p}</p></li><li data-main><p>{p}</p></li></ul>",
    "<h2 data-main>{t}</h2><pre data-main>{p}</pre><p data-main>{p}</p>",
    "<div{@main} data-main><h1>{t}</h1><dl><dt>{w}</dt><dd>{p}</dd><dt>{w}</dt><dd>{s}</dd></dl><p>{p}</p></div>",
]
ABOVE = [
    "<header{@top}><a href='/'>{t}</a><nav><ul>{links}</ul></nav></header>",
    "<div{@top}><a href='/'>{w}</a></div><div{@menu}><ul>{links}</ul></div>",
    "<div{@top}><p>{s}</p></div><ul{@menu}>{links}</ul>",
    "<div{@top}>{w} <a href='/'>{w}</a> <a href='/'>{w}</a> <a href='/'>{w}</a></div>",
    "<nav><a href='/'>{w}</a> <a href='/'>{w}</a></nav><div{@note}><p>{p}</p><button>{w}</button></div>",
    "<table><tr><td><a href='/'>{w}</a></td><td><a href='/'>{w}</a></td></tr></table>",
    "<div{@top}><h1><a href='/'>{t}</a></h1><p>{w}</p></div><div{@menu}><a href='/'>{w}</a> <a href='/'>{w}</a></div>",
    "<form><label>{w}</label><input></form><div{@ad}>{p}</div>",
    "<header{@top}><p>{s}</p><h2>{t}</h2></header><div{@note}>{s}</div>",
    "<div{@ad}><p>{s}</p></div><header><h1>{t}</h1><p>{p}</p></header>",
    "",
]
BESIDE = [
    "<aside{@side}><h3>{t}</h3><ul>{links}</ul></aside>",
    "<div{@side}><h3>{t}</h3><ul>{links}</ul><h3>{t}</h3><ul>{links}</ul></div>",
    "<div{@talk}><h3>{t}</h3><div class=comment><p>{p}</p></div><div class=comment><p>{s}</p></div></div>",
    "<section{@talk}><h2>{t}</h2><ol><li><p>{p}</p><p>{s}</p></li><li><p>{p}</p></li></ol><form><p>{w}</p></form></section>",
    "<div{@note}><p>{s}</p><form><input></form></div><div{@side}><ul>{links}</ul></div>",
    "<div{@talk}><div>{s}</div><div>{p}</div><div>{s}</div></div><div{@ad}><p>{p}</p></div>",
    "<aside><p>{p}</p></aside><div{@share}><a href='/x'>{w}</a> <a href='/y'>{w}</a></div>",
    "",
]
BELOW = [
    "<footer{@foot}><p>{s}</p><ul>{links}</ul></footer>",
    "<div{@foot}><p>&copy; {t}</p></div>",
    "<div{@foot}>&copy; {w} {w}. <a href='/'>{w}</a> <a href='/'>{w}</a></div>",
    "<div{@foot}>{w} <a href='/'>{w}</a> <a href='/'>{w}</a> <a href='/'>{w}</a></div>",
    "<footer>{s}</footer>",
    "<hr><p><small>&copy; {t}. <a href='/'>{w}</a></small></p>",
    "",
]


def layouts(without: str | None = None, only: str | None = None, each: int = 3, seed: int = 3) -> list[str]:
    """All whole pages (three times, as they are whole), and every body with drawn parts;
    tests leave one of them out (`without`) or ask for pages of one body (`only`)."""
    rng = random.Random(seed)
    built = [f"<html><body>{rng.choice(ABOVE)}<div{{@wrap}}>{body}{rng.choice(BESIDE)}</div>{rng.choice(BELOW)}"
             "</body></html>" if i % 2 else
             f"<html><body>{rng.choice(ABOVE)}{body}{rng.choice(BESIDE)}{rng.choice(BELOW)}</body></html>"
             for i in range(each) for body in BODIES if (body == only if only else body != without)]
    return built if only else 3 * [layout for layout in LAYOUTS if layout != without] + built


def filler(rng: random.Random):
    def word():
        return "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))

    def sentence():
        return " ".join(word() for _ in range(rng.randint(3, 14))).capitalize() + "."

    def paragraph():
        text = " ".join(sentence() for _ in range(rng.randint(2, 9)))
        return text if rng.random() < 0.8 else f"{text[:-1]}{rng.choice(('', '***', ' (1)', '&amp;'))}"

    def some(make, lo, hi):
        return "".join(make() for _ in range(rng.randint(lo, hi)))

    def name(role):
        if role not in CERTAIN and rng.random() < 0.4:
            return ""
        return f' {rng.choice(("class", "class", "id"))}="{rng.choice(NAMES[role].split())}"'

    return {
        **{f"@{role}": lambda role=role: name(role) for role in NAMES},
        "own paras": lambda: some(lambda: f"<p data-main>{rng.choice((paragraph, sentence))()}</p>", 2, 6),
        "w": word, "s": sentence, "p": paragraph,
        "t": lambda: " ".join(word() for _ in range(rng.randint(2, 8))),
        "links": lambda: some(lambda: f'<li><a href="/{word()}">{word()}</a></li>', 3, 8),
        "items": lambda: some(lambda: f"<li>{rng.choice((sentence, paragraph, word))()}</li>", 2, 6),
        "paras": lambda: some(lambda: f"<p>{rng.choice((paragraph, paragraph, sentence, word))()}</p>",
                              1, 7),
    }


def fill_in(templates: list[str], copies: int, seed: int) -> list[str]:
    fill = filler(random.Random(seed))
    return [re.sub(r"\{(@?\w[\w ]*)\}", lambda m: fill[m[1]](), template)
            for _ in range(copies) for template in templates]


def labelled_pages(copies: int = 10, seed: int = 7, without: str | None = None) -> list[str]:
    return fill_in(layouts(without), copies, seed)
