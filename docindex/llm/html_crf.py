"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: the text between two block-level tags. Every block has features of its ancestors (tag
names, groups of words in class, id and role attributes, the innermost of them that says something about layout) and of
its text (length, share of link text, end, cue words). The field labels the blocks of a page, in page order, as main
text or not; it is trained on the labelled pages below on the driver (a fixed, small table) and decoded by Viterbi for
all pages of a chunk at once.

Scripts, styles, comments and templates never become blocks, nor do titles, descriptions and definitions of drawings and
annotations of formulas. Text inside formulas, drawings, objects, media, frames and noscript is text of the line around it;
such a part ends at its end tag, or with its parent. Character references are decoded, white space
inside a block becomes one space, blocks are trimmed and joined by one line feed; nothing else is dropped or capped.
The parser is a single scan, closes what HTML closes by itself (p, li, td, ...) and ignores stray end tags.

One pass, no shuffle. A null or empty page has an empty text; a page of any length is read whole; repeated rows get
the same text; other columns are left out.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docindex.llm import crf, textvec as tv

# ---------------------------------------------------------------- parser
# A quote opens a value only after "="; elsewhere it is an ordinary character.
_TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=(?:\s*(?:"[^"]*"|'[^']*'))?)*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
# Fixed values of HTML: tags without content, tags whose content is no text, embedded content, tags inside a line of text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style template".split())
_EMBED = frozenset("noscript iframe svg math object canvas audio video".split())
_FOREIGN = ("svg", "math")
#: Parts of foreign content that nobody sees, those that hold HTML again, and tags that end foreign content.
_UNSEEN = {"svg": frozenset("title desc metadata defs symbol".split()), "math": frozenset(["annotation", "annotation-xml"])}
_HOSTS = frozenset("foreignobject mtext mi mo mn ms".split())
_BREAKOUT = frozenset("""article aside b big blockquote body br center code dd div dl dt em embed figure footer form h1 h2 h3 h4 h5 h6 head header hr i img
li listing main menu meta nav nobr ol p pre ruby s section small span strong strike sub sup table tt u ul var""".split())
_UNQUOTED = re.compile(r"""=\s*[^\s"'>]+$""")  # a slash at the end of such a value closes nothing
_INLINE = frozenset("""a abbr acronym b bdi bdo big br button cite code data del dfn em font i img ins kbd label mark nobr output picture q rb rp rt rtc ruby
    s samp small span strike strong sub sup time tt u var wbr""".split())


def _is_inline(tag: str) -> bool:
    """Inline elements do not end a block; elements of a page's own (their names have a hyphen) are inline as well."""
    return tag in _INLINE or "-" in tag


#: A start tag closes open tags of these names, up to the nearest of the barriers.
_CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "tbody": "tr td th thead"}
_BARRIER = frozenset("ul ol dl table select body".split())

#: Words in class, id and role that tell what a part of a page is for.
GROUPS = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs toc pager pagination tabs skip navi navegacion menue",
    "header": "header masthead topbar head kopf kopfzeile kopfbereich entete cabecera encabezado",
    "footer": "footer foot copyright colophon legal contentinfo imprint fuss fusszeile fussbereich impressum pied piedpage pie",
    "side": "sidebar aside side rail widget related recommended trending popular complementary teaser seitenleiste randspalte marginale barralateral lateral",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner adsense outbrain taboola werbung anzeige anzeigen publicite pub publicidad anuncio",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe paywall disclaimer toast dialog hinweis avis aviso",
    "comment": "comment comments commentlist reply replies disqus respond discussion kommentar kommentare commentaire commentaires comentario comentarios",
    "form": "form search searchbox login signup register",
    "share": "share social sharing follow",
    "main": "article content main post entry story",
}
#: Words that may follow a group's word in a name; after any other word ("related-work") the name tells nothing.
_STRUCTURE = frozenset("""area articles bar block body bottom box btn button buttons center col column container content desktop div entry field footer fixed grid group
    header holder icons id inner item items left link links list main mobile module news outer page panel posts primary reading right row secondary section sec
    side site slot small stories sticky strip text thread title top unit view widget widgets wrap wrapper zone form input""".split())
#: Names that make an <aside> a part of the text.
_QUOTED = frozenset("pullquote quote blockquote callout infobox factbox footnote footnotes epigraph".split())
_GROUP_OF = {w: g for g, words in GROUPS.items() for w in words.split()}
_TAG_GROUP = {"nav": "nav", "menu": "nav", "header": "header", "footer": "footer", "aside": "side", "form": "form", "button": "form", "select": "form",
              "label": "form", "fieldset": "form", "textarea": "form", "dialog": "notice", "article": "main", "main": "main", "head": "head", "title": "head"}
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_TOKEN = re.compile(r"[a-z]+")
_LEAF = {t: i + 1 for i, t in enumerate("p h1 h2 h3 h4 h5 h6 li div td th pre blockquote section article figcaption dd dt body".split())}
_INNER = {g: i + 1 for i, g in enumerate([*GROUPS, "head", "hidden"])}
_BITS = {g: 1 << i for i, g in enumerate([*GROUPS, "head", "hidden"])}
_CUES = re.compile(r"©|copyright|all rights reserved|cookie|privacy|subscribe|sign up|log ?in|advert|sponsor|repl(?:y|ies)\b|comments?\b|share|read more|related", re.I)


def _groups(tag: str, attributes: str) -> list:
    """Layout groups that a tag and its attributes name, most telling last."""
    out = [_TAG_GROUP[tag]] if tag in _TAG_GROUP else []
    if attributes:
        for m in _NAMED.finditer(attributes):
            name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                out.append("hidden")
            elif name in ("class", "id", "role"):
                parts = [_TOKEN.findall(one) for one in value.split()]
                if tag == "aside" and any(w in _QUOTED for words in parts for w in words):
                    out = [g for g in out if g != "side"]
                named = [_GROUP_OF[w] for words in parts for k, w in enumerate(words)
                         if w in _GROUP_OF and all(x in _GROUP_OF or x in _STRUCTURE or len(x) == 1 for x in words[k + 1:])]
                # "article-comments", "content-sidebar": the part that is not main text tells more.
                out += sorted(named, key=lambda g: g != "main")
    return out


_ENDS = {t: re.compile(rf"<(/?){t}(?![^\s/>])[^>]*>", re.I) for t in {*_RAW, *_UNSEEN["svg"], *_UNSEEN["math"]}}
_ENDS_AT_ONCE = {t: re.compile(rf"[^<]*</{t}\s*>", re.I) for t in _RAW}


def _end_of(tag: str, page: str, at: int, nested: bool):
    """Place after the end tag that belongs to a start tag before ``at``, or None."""
    depth = 1
    for m in _ENDS[tag].finditer(page, at):
        if m[1]:
            depth -= 1
        elif nested and not m[0].endswith("/>"):
            depth += 1
        if not depth:
            return m.end()
    return None


def blocks(page: str) -> list:
    """Leaf blocks of a page in order: (text, ancestor bits, innermost group, leaf tag, link characters)."""
    out: list = []
    stack = [("", 0, 0)]  # (tag, bits of all ancestors, innermost group)
    parts: list = []
    links = in_link = 0

    def flush():
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                leaf = next((t for t, _, _ in reversed(stack) if not _is_inline(t)), "")
                out.append((text, stack[-1][1], stack[-1][2], _LEAF.get(leaf, 0), links))
            parts.clear()
        links = 0

    def say(raw):
        nonlocal links
        if raw:
            text = unescape(raw) if "&" in raw else raw
            parts.append(text)
            if in_link:
                links += len(text)

    def close(name):
        nonlocal in_link
        while True:
            last = stack.pop()[0]
            open_tags[last] -= 1
            in_link -= last == "a"
            if last == name:
                break

    at, end = 0, len(page)
    open_tags: dict = {}
    while at < end:
        m = _TAG.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at: m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        empty = attributes.endswith("/") and not _UNQUOTED.search(attributes)
        foreign = next((t for t in _FOREIGN if open_tags.get(t)), None)
        if foreign and not closing and tag in _BREAKOUT and not any(open_tags.get(t) for t in _HOSTS):
            for t in _FOREIGN:  # never closed: HTML goes on
                while open_tags.get(t):
                    close(t)
            foreign = None
        if foreign and tag == "foreignobject":
            flush()
        inside = foreign and not open_tags.get("foreignobject") and tag not in _BREAKOUT and not (closing and open_tags.get(tag) and tag in _LEAF)
        inline = _is_inline(tag) or tag in _EMBED or inside
        if not inline and tag not in _RAW:
            flush()
        elif tag == "br" or foreign == "svg" and tag == "text":
            parts.append(" ")
        if closing:
            if open_tags.get(tag):
                close(tag)
            continue
        if tag in _RAW:
            if empty:  # as in XHTML; an end tag may stand right behind it all the same
                after = _ENDS_AT_ONCE[tag].match(page, at)
                at = after.end() if after else at
            else:
                at = _end_of(tag, page, at, tag == "template") or end
            continue
        if foreign and not empty and tag in _UNSEEN[foreign]:
            at = _end_of(tag, page, at, True) or at
            continue
        if empty and (inside or tag in _EMBED):
            continue
        if tag in _VOID or attributes.endswith("/") and not _is_inline(tag) and tag not in _LEAF:
            continue
        if not inline and open_tags.get("p"):  # a block-level tag ends an open paragraph
            close("p")
        if tag in _CLOSES:
            names = _CLOSES[tag].split()
            k = len(stack) - 1
            cut = None
            while k > 0 and stack[k][0] not in _BARRIER and len(stack) - k < 64:
                if stack[k][0] in names:
                    cut = k
                k -= 1
            while cut is not None and len(stack) > cut:
                name = stack.pop()[0]
                open_tags[name] -= 1
                in_link -= name == "a"
        if tag == "a" and in_link:  # links do not nest
            close("a")
        _, bits, inner = stack[-1]
        for g in _groups(tag, attributes):
            bits |= _BITS[g]
            inner = _INNER[g]
        stack.append((tag, bits, inner))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        in_link += tag == "a"
    flush()
    return out


# ---------------------------------------------------------------- features
_SIZES = [3, 6, 11, 21, 51]
_N_GROUPS = len(_BITS)
#: Values: innermost group, whether a main part is around, leaf tag, words, link share, end, cue with size; one per group that is around.
CARDS = [len(_INNER) + 1, (len(_INNER) + 1) * 2, len(_LEAF) + 1, (len(_SIZES) + 1) * 2, 4, 2 * 2, 2 * (len(_SIZES) + 1)]
_OFFSETS = np.concatenate([[0], np.cumsum(CARDS)])
N_FEATURES = int(_OFFSETS[-1]) + _N_GROUPS + 1
_WIDTH = len(CARDS) + _N_GROUPS


def features(found: list) -> list:
    """Feature numbers of one block each; groups that are not around give the padding feature."""
    out = []
    for text, bits, inner, leaf, links in found:
        size = int(np.searchsorted(_SIZES, text.count(" ") + 1, side="right"))
        share = links / len(text)
        main = 1 if bits & _BITS["main"] else 0
        ends = 1 if text[-1] in ".!?:…\"'»”" else 0
        cue = 1 if _CUES.search(text) else 0
        row = [inner, inner * 2 + main, leaf, size * 2 + main, 0 if not share else 1 if share < 0.3 else 2 if share < 0.7 else 3,
               ends * 2 + main, cue * (len(_SIZES) + 1) + size]
        row = [int(x + o) for x, o in zip(row, _OFFSETS)]
        row += [int(_OFFSETS[-1]) + g if bits >> g & 1 else N_FEATURES - 1 for g in range(_N_GROUPS)]
        out.append(row)
    return out


# ---------------------------------------------------------------- labelled pages
# One page a line; a block that opens with § is main text.
LABELLED = """\
<html><head><title>On rivers</title></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav><article><h1>§On rivers</h1><p>§Rivers run to the sea, and the sea is never full.</p><p>§So it goes.</p><p>§Short one</p></article><footer>© 2020 Site. All rights reserved.</footer></body></html>
<html><head><title>T</title></head><body><nav><ul><li><a href=/a>The</a></li><li><a href=/b>and</a></li></ul></nav><div class="ad">Buy this thing. It is good for you and yours.</div><article><h1>§THE!! WATER!!</h1><p><b>§THE!! WATER!! IS!! WIDE!!<br><p>§I%%% cannot$$$ get### over&&&.</p><p>§And | neither | have | I | wings.</p><p>§To fly.</p></article><footer>© www.site.example.com · It was a dark night. The rain fell in torrents.</footer></body></html>
<body><header><h1>The Daily Paper</h1><p>News that matters to you since 1900.</p></header><main><h1>§Council votes</h1><p>§The council voted on Monday to build the bridge after a long debate.</p><h2>§What now</h2><ul><li>§More talks</li><li>§A budget</li></ul><p>§Work begins in May, <a href=/x>officials said</a>.</p></main><aside><h3>Most read</h3><ul><li><a href=/1>Ten tips for a better garden this spring</a></li></ul></aside><footer><p>Contact us by phone or letter at our office in town.</p></footer></body>
<body><div id="topbar">Welcome to our site</div><div class="menu"><a href=/1>One</a> <a href=/2>Two</a></div><div class="content"><div class="post"><h2>§A walk</h2><p>§We walked along the coast for three days and saw nobody.</p><p>§It rained.</p></div><div class="comments"><h3>2 comments</h3><div class="comment"><p>Nice text, I liked it very much and will come back.</p></div><div class="comment"><p>I disagree with all of it.</p></div></div></div><div class="sidebar"><p>About the author: she writes about walks.</p></div><div class="footer">Imprint</div></body>
<body><div class="cookie-notice"><p>We use cookies to make this site better for you.</p><button>Accept</button></div><article class="story"><h1>§Bread</h1><p>§Mix flour and water. Wait for a day.</p><div class="advert"><p>Sponsored: the best ovens of the year, now at half the price.</p></div><p>§Bake it for an hour.</p><pre>§temp = 230</pre><blockquote>§Bread is life.</blockquote><section id="comments"><p>Great recipe! It worked well for me on the first try.</p><p>Mine was burnt.</p></section></article><form action=/s><label>Search</label><p>Type what you look for and press enter.</p></form></body>
<body><div role="navigation"><p>Skip to the text</p><a href=/>Start</a></div><div role="main"><p>§The first paragraph is here, and it is long enough to be a paragraph.</p><div>§A bare division with some text in it, as many pages have.</div><table><tr><td>§Cell one</td><td>§Cell two</td></tr></table><figure><figcaption>§A view of the lake.</figcaption></figure></div><div role="complementary"><p>Related stories that you might like to read as well today.</p></div><div role="contentinfo">Legal</div></body>
<body><article><header><h1>§A title</h1></header><nav><a href=#1>Part one</a></nav><p>§This is the text of the article, which goes on for a while.</p><aside><p>In this box is a note from our partners about their product.</p></aside><div class="share"><a href=/f>Share this</a></div><p>§The end.</p><div class="newsletter"><p>Subscribe to our letter and get the news every morning.</p></div><footer><p>Posted in travel by our staff.</p></footer></article><section class="comments"><article class="comment"><p>First! What a fine article, thank you for it.</p></article><article class="comment"><p>Indeed so.</p></article></section></body>
<body><div class="banner">Big sale now on</div><div class="entry-content"><p>§One day a fox saw some grapes hanging high on a vine.</p><p>§He jumped.</p><p>§They were sour, he said.</p></div><div class="related"><h4>More fables</h4><p>The hare and the tortoise ran a race one summer day.</p></div><div class="popup"><p>Please log in to read on.</p></div><div style="display:none"><p>This is hidden text for machines that nobody sees.</p></div></body>
<body><p>§A plain page without any layout at all.</p><p>§It has only paragraphs, one after the other, in a row.</p><p>§And a third.</p></body>
<body><h1>§Plain heading</h1><div>§Some pages put their text in a division and nothing more than that.</div><ul><li><a href=/1>Home</a></li><li><a href=/2>About us</a></li></ul><p>§Last words of the page.</p></body>
<body><article><p>§x</p></article><div class="ads"><p>Cheap flights to all the cities of the world, book now.</p></div><div id="disqus_thread"><p>Loading the discussion of this page, please wait a moment.</p></div></body>
<body><div id="header"><a href=/>Logo</a><p>A line about us that is a whole sentence long.</p></div><div id="main"><div id="article-body"><p>§Text in the middle of nested parts, which is what we want.</p><p>§Copyright is a right, the court said, and comments on it are many.</p><ol><li>§First point of the list is made.</li><li>§Second</li></ol></div><div id="article-comments"><p>Reader one says that the court is wrong about it.</p></div></div><div id="footer"><p>Privacy and terms of use of this site are found here.</p></div></body>
<body><main><article><h2>§Deux mots</h2><p>§La mer est calme ce soir, et le vent est tombé.</p><p>§FIN!!</p></article><aside class="sidebar"><p>À lire aussi : les plus beaux ports de la côte.</p></aside><div class="alert">Attention, site en travaux.</div></main><footer><ul><li><a href=/m>Mentions</a></li></ul><p>Fait avec soin par une petite équipe dans une grande ville.</p></footer></body>""".split("\n")


def train():
    """Weights and transitions of the field from the labelled pages."""
    rows, gold, first = [], [], [0]
    for page in LABELLED:
        found = blocks(page)
        gold += [int(b[0].startswith("§")) for b in found]
        rows += features([(b[0].lstrip("§") or "x", *b[1:]) for b in found])
        first.append(len(rows))
    return crf.fit(np.array(rows), np.array(gold), np.array(first), N_FEATURES, 2)


def main_texts(pages: list, model) -> list:
    """Main text of each page: the blocks labelled as such, joined by line feeds."""
    weights, moves = model
    found = [blocks(p) for p in pages]
    first = np.concatenate([[0], np.cumsum([len(f) for f in found])])
    rows = [r for f in found for r in features(f)]
    if not rows:
        return [""] * len(pages)
    labels = crf.viterbi(weights[np.array(rows)].sum(axis=1), moves, first)
    return ["\n".join(b[0] for b, label in zip(f, labels[a:]) if label) for f, a in zip(found, first)]


def extract(pages: DataFrame, key: str = "page_id", html: str = "html", keep=(), chunk_chars: int = 1 << 21) -> DataFrame:
    """One row a page: key, the columns named in ``keep``, text, n_chars."""
    model = train()
    columns = [key, *keep]

    def run(batches):
        for batch in batches:
            column = batch.column(len(columns))
            lo = 0
            while lo < batch.num_rows:
                hi, size, texts = lo, 0, []
                while hi < batch.num_rows and size < chunk_chars:
                    texts.append(column[hi].as_py() or "")
                    size += len(texts[-1])
                    hi += 1
                out = main_texts(texts, model)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(lo, hi - lo) for k in range(len(columns))), pa.array(out, pa.string()),
                     pa.array([len(t) for t in out], pa.int64())], [*columns, "text", "n_chars"])
                lo = hi

    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in columns)
    return pages.select(*columns, F.col(html)).mapInArrow(tv.returning(run), f"{kinds}, text string, n_chars long")
