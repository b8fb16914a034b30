"""Labelled pages for the content extractor: small pages whose parts are known to be content or not.

They are synthetic: put together from the lists below, so that every kind of part occurs beside, before, after and inside an article.
"""

from __future__ import annotations

#: Names that parts of pages go by, in class and id attributes.
OUTSIDE = (
    "ad ads advert advertisement adsense adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe "
    "subscription signup sidebar widget rail related recommended trending popular menu nav navbar navigation breadcrumb breadcrumbs pagination header masthead topbar toolbar footer "
    "colophon copyright comment comments respond reply replies disqus discussion feedback share sharing social follow form search login register skip disclaimer legal tagcloud "
    "werbung anzeige anzeigen kommentar kommentare teilen verwandt seitenleiste fusszeile impressum datenschutz anmelden publicite annonce annonces commentaire commentaires partager partage "
    "pied connexe publicidad anuncio anuncios comentario comentarios compartir relacionados suscripcion boletin pie reklama reklamnyy kommentarii kommentariy podelitsya podpiska"
).split()
INSIDE = "article content post entry story main body text maincontent articlebody blog page hentry prose".split()
ELEMENTS_OUTSIDE = ("nav", "header", "footer", "aside", "form")
WORDS = "the river carried late snow past a quiet mill where two carpenters mended nets and told long stories to children".split()


def _words(n: int, start: int = 0) -> str:
    return " ".join(WORDS[(start + k) % len(WORDS)] for k in range(n))


def _outside(tag: str, name: str, form: int) -> str:
    attribute = f' class="{name}"' if name else ""
    inner = (f"<ul><li><a href='#'>{_words(2)}</a></li><li><a href='#'>{_words(1, 3)}</a></li></ul>", f"<p>{_words(9, form)}</p>", f"{_words(4, form)} <a href='#'>{_words(1)}</a>")[form % 3]
    return f"<{tag}{attribute}>{inner}</{tag}>"


def _content(k: int) -> str:
    return f"<h1>{_words(4, k)}</h1><p>{_words(14, k)} <a href='#'>{_words(2, k)}</a> {_words(6, k)}</p><p><b>{_words(11, k)}</b><br>{_words(8, k)}</p><ul><li>{_words(3, k)}</li></ul>"


def pages() -> list[tuple[list[tuple[bool, str]], None]]:
    """Pages as lists of (is content, markup); the parts joined are the page, which nests parts by open and close markup of no words."""
    out = []
    kinds = [("div", name) for name in OUTSIDE] + [("section", name) for name in OUTSIDE] + [(tag, "") for tag in ELEMENTS_OUTSIDE for _ in range(6)]
    for k, (tag, name) in enumerate(kinds):
        home = ("<article>", "</article>") if k % 3 == 0 else ("<main>", "</main>") if k % 3 == 1 and k % 2 else (f'<div class="{INSIDE[k % len(INSIDE)]}">', "</div>")
        other = kinds[(7 * k + 3) % len(kinds)]
        parts = [(False, "<html><body>"), (False, _outside("nav", "", 0)), (False, _outside(tag, name, k)), (False, home[0]), (True, _content(k))]
        parts += [(False, _outside(tag, name, k + 1)), (True, _content(k + 5)), (False, home[1]), (False, _outside(*other, k + 2))]
        if k % 4 == 0:  # readers' comments are often articles of their own
            parts.append((False, f'<section class="comments"><article><p>{_words(12, k)}</p></article></section>'))
        if k % 5 == 0:  # a page without structure
            parts = [(False, "<html><body>"), (False, _outside("nav", "", 0)), (True, _content(k)), (False, _outside(tag, name, k)), (False, _outside("footer", "", 1))]
        out.append((parts + [(False, _outside("footer", "", k)), (False, "</body></html>")], None))
    return out
