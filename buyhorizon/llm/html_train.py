"""Labelled pages to train the extraction on, made from layout rules.

Each page mixes a main text with menus, headers, footers, sidebars, notices,
adverts, forms and reader comments, in the tags and class names that sites use,
partly with unclosed elements. Every block's text starts with a mark that tells
its label; the marks are taken off before features are made.
"""

from __future__ import annotations

import random

MAIN, OTHER = "", ""

# fixed values: class and id words of page parts
NAMES = {
    "menu": "nav menu navbar navigation main-nav top-menu site-nav breadcrumb breadcrumbs topbar toolbar tabs pagination skip-links language-switcher".split(),
    "header": "header masthead site-header page-header top banner logo branding tagline".split(),
    "footer": "footer site-footer page-footer bottom copyright legal colophon credits footer-links imprint".split(),
    "sidebar": "sidebar side aside widget widgets right-column related related-posts trending popular recent-posts most-read tag-cloud archive author-box rail recommended".split(),
    "notice": "notice cookie cookie-notice cookie-banner consent gdpr alert warning message announcement popup modal overlay paywall newsletter-promo disclaimer privacy toast".split(),
    "advert": "ad ads advert advertisement sponsored sponsor promo promotion banner-ad ad-slot adsense commercial affiliate google-ad partner".split(),
    "form": "form search search-form login signup subscribe subscription newsletter contact-form register poll survey".split(),
    "comments": "comments comment comment-list reader-comments discussion responses replies reply thread disqus user-comments feedback reviews comment-body".split(),
    "share": "share social sharing social-links share-buttons follow meta-links tags actions".split(),
}
BODIES = ["<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<article class="post">{}</article>', '<div class="content">{}</div>',
          '<div id="main">{}</div>', '<div class="article-body">{}</div>', '<div class="post-content entry">{}</div>', '<section class="story">{}</section>',
          '<div id="content" class="main-content"><div class="text">{}</div></div>', '<article class="entry hentry"><div class="entry-content">{}</div></article>', "{}",
          '<table><tr><td class="body">{}</td></tr></table>', '<div class="page"><div class="inner">{}</div></div>', '<article itemprop="articleBody">{}</article>']


class Maker:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.rng
        letters = r.choice(["etaoinshrdlu", "enisratdhulä", "aeosrnidlcñó", "esaitnrulé"])
        out = ["".join(r.choices(letters, k=r.randint(1, 10))) for _ in range(r.randint(low, high))]
        if r.random() < 0.6:
            out = [w + r.choice([".", ",", "", "", "", ""]) for w in out]
            out[0] = out[0].capitalize()
            out[-1] = out[-1].rstrip(",.") + r.choice([".", ".", "!", "?", ""])
        kind = r.random()
        if kind < 0.08:
            out = [w + r.choice(["$$$", "***", "###", "&amp;&amp;", "!!"]) for w in out]
        elif kind < 0.12:
            out = [w.upper() for w in out]
        elif kind < 0.16:
            out = [out[0]] * len(out)
        elif kind < 0.2:
            out = " | ".join(out).split(" ")
        elif kind < 0.25:
            out[r.randrange(len(out))] = r.choice(["user@example.com", "+1 (555) 010-9999", "https://example.com/a?b=1", "2024", "&quot;x&quot;"])
        return " ".join(out)

    def inline(self, text: str, mark: str) -> str:
        r, parts = self.rng, text.split(" ")
        if len(parts) > 3 and r.random() < 0.3:
            i = r.randrange(len(parts))
            parts[i] = r.choice(['<a href="/x">{}</a>', "<b>{}</b>", "<em>{}</em>", "<span>{}</span>"]).format(parts[i])
        return mark + " ".join(parts)

    def open(self, part: str, tags: str) -> tuple[str, str]:
        r = self.rng
        tag, name = r.choice(tags.split()), r.choice(NAMES[part])
        own = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}.get(part)
        plain = tag == own and r.random() < 0.6
        return (f"<{tag}>" if plain else f'<{tag} {r.choice(["class", "class", "id"])}="{name}">'), f"</{tag}>"

    def list_of_links(self, low=2, high=9, mark=OTHER) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{mark}{self.words(1, 4)}</a></li>' for i in range(self.rng.randint(low, high))) + "</ul>"

    def other(self, part: str) -> str:
        r = self.rng
        a, b = self.open(part, {"menu": "nav nav div ul", "header": "header header div", "footer": "footer footer div", "sidebar": "aside aside div section", "notice": "div div aside section p",
                                "advert": "div div aside ins section", "form": "form form div", "comments": "section div div ol aside", "share": "div ul p"}[part])
        text = lambda low, high: self.inline(self.words(low, high), OTHER)
        if part == "menu":
            inner = self.list_of_links() if r.random() < 0.8 else " ".join(f'<a href="/{i}">{OTHER if not i else ""}{self.words(1, 2)}</a>' for i in range(4))
        elif part == "header":
            inner = f"<h1>{text(1, 5)}</h1>" * (r.random() < 0.5) + f"<p>{text(2, 10)}</p>" * (r.random() < 0.6) + self.list_of_links(1, 5) * (r.random() < 0.4) or f"<div>{text(1, 4)}</div>"
        elif part == "footer":
            inner = r.choice([f"{OTHER}&copy; {self.words(1, 12)}", f"<p>{text(2, 25)}</p>", self.list_of_links() + f"<p>{OTHER}Copyright {self.words(2, 6)}</p>"])
        elif part == "sidebar":
            inner = f"<h3>{text(1, 4)}</h3>" * (r.random() < 0.6) + r.choice([self.list_of_links(), f"<p>{text(3, 50)}</p>", f"<p>{text(3, 30)}</p><p>{text(3, 30)}</p>"])
        elif part == "form":
            inner = f"<label>{text(1, 4)}</label><input name=q><button>{text(1, 2)}</button>" + f"<p>{text(3, 14)}</p>" * (r.random() < 0.4) + f"<select><option>{text(1, 2)}<option>{text(1, 2)}</select>" * (r.random() < 0.2)
        elif part == "comments":
            item = lambda: f'<{t}{r.choice(["", " class=comment", " class=reply"])}>' + f"<b>{OTHER}{self.words(1, 2)}</b>" * (r.random() < 0.4) + f"<p>{text(2, 70)}</p></{t}>"
            t = "li" if a.startswith("<ol") else r.choice(["div", "article", "li"])
            inner = f"<h2>{text(1, 4)}</h2>" * (r.random() < 0.6) + "".join(item() for _ in range(r.randint(1, 6)))
        elif part == "share":
            inner = f'<a href="#">{OTHER}{self.words(1, 2)}</a> <a href="#">{self.words(1, 1)}</a>'
        else:
            inner = r.choice([text(2, 25), f"<p>{text(2, 30)}</p>", f'<a href="/x">{OTHER}{self.words(2, 10)}</a>', f"<p>{text(2, 20)}</p><button>{text(1, 2)}</button>"])
        return a + inner + b

    def main(self) -> str:
        r = self.rng
        text = lambda low, high: self.inline(self.words(low, high), MAIN)
        head = f"<h1>{text(1, 12)}</h1>"
        out = [r.choice([head, head, f"<header>{head}</header>", ""])]
        sloppy = r.random() < 0.3
        for _ in range(r.choice([1, 2, 3, 4, 6, 9, 14])):
            k = r.random()
            low, high = r.choice([(1, 3), (5, 30), (20, 120), (20, 120)])
            if sloppy and k < 0.5:
                out.append(f"<p><b>{text(low, high)}<br>")
            elif k < 0.72:
                out.append(f"<p>{text(low, high)}</p>")
            elif k < 0.78:
                level = r.randint(2, 4)
                out.append(f"<h{level}>{text(1, 8)}</h{level}>")
            elif k < 0.83:
                out.append("<ul>" + "".join(f"<li>{text(1, 20)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif k < 0.86:
                out.append(f"<blockquote><p>{text(low, high)}</p></blockquote>")
            elif k < 0.88:
                out.append(f"<table><tr><th>{text(1, 3)}<td>{text(1, 6)}</table>")
            elif k < 0.9:
                out.append(f"<figure><img src=x><figcaption>{text(2, 15)}</figcaption></figure>")
            elif k < 0.92:
                out.append(f"<pre>{text(2, 15)}</pre>")
            elif k < 0.94:
                out.append(f"<div>{text(low, high)}</div>")
            else:
                out.append(self.other(r.choice(["advert", "notice", "share", "form", "sidebar", "comments"])))
        return "".join(out)

    def wrapped(self, part: str) -> str:
        r = self.rng
        while part and r.random() < 0.25:
            part = f'<div{r.choice(["", " class=wrapper", " class=container", " id=page", " class=row", " class=col-8", " class=section"])}>{part}</div>'
        return part

    def page(self) -> str:
        r = self.rng
        only_main = r.random() < 0.12
        some = lambda part, p: self.wrapped(self.other(part)) if r.random() < p and not only_main else ""
        body = some("notice", 0.25) + some("header", 0.5) + some("menu", 0.7) + some("advert", 0.45) + some("form", 0.2)
        side = some("sidebar", 0.35)
        text = self.wrapped(r.choice(BODIES).format(self.main().replace("{", "").replace("}", "")))
        body += r.choice([side + text, text + side]) if r.random() < 0.97 else side
        body += some("share", 0.2) + some("sidebar", 0.2) + some("form", 0.2) + some("comments", 0.35) + some("advert", 0.2) + some("menu", 0.1) + some("footer", 0.8) + some("notice", 0.15)
        if r.random() < 0.1:
            return body
        body = self.wrapped(body)
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 8)}</title><script>var a='</p>';</script></head><body>{body}" + "</body></html>" * (r.random() < 0.9)


def labelled_pages(n: int, seed: int = 1) -> list[str]:
    maker = Maker(seed)
    return [maker.page() for _ in range(n)]
