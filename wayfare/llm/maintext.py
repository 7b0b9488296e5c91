"""Main text of HTML pages by two passes of block rules.

A page is cut into blocks at block-level tags. Pass 1 decides on each block alone: by the part of the page
that holds it (menus, headers, footers, sidebars, notices, adverts, forms and comments are never text), by
its link density, its length and its density of stop words. Short blocks stay open. In pass 2 an open block
takes the label of its nearest decided neighbours in the same part of the page.

A class or id marks such a part by a whole word of `HINTS` or a compound of them with `QUALIFIERS` ("site-footer",
not "has-sidebar"). A mark of that kind never holds for a main element inside, nor for an article inside that has
more text than all that is left of the page. Where the long blocks of a page hold few of the stop words, its language is
not covered and length and link density decide alone.

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed
and joined in page order by one newline. Nothing else is dropped or cut.

Edge cases: null, empty or text-free html gives an empty text; html that ends in the middle of a tag,
comment or script loses that part only; repeated rows give repeated rows; columns other than id, url and
html are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT, LONG = 70, 200
LINKS, STOP_LOW, STOP_HIGH = 0.2, 0.30, 0.32
COVERED = 0.2

#: Elements that end a block, that never hold text, that never hold main text, that hold it.
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
            "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section "
            "select summary table tbody td tfoot th thead title tr ul".split())
SILENT = set("script style noscript template iframe svg math object canvas textarea audio video".split())
OUTSIDE = set("aside button dialog footer form head header label menu nav option select title".split())
INSIDE = {"article", "main"}
INLINE = {"button", "label"}  # words of a sentence, where no form is open
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words of a class or id, and roles, of parts that are not main text.
HINTS = set("ad ads adv advert advertisement adverts adslot banner breadcrumb breadcrumbs comment comments consent "
            "cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar "
            "navigation newsletter notice notices pager pagination paywall popup promo promotion promoted related "
            "replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription "
            "teaser toolbar topbar widget widgets".split())
#: Words that make a compound of a hint and still name that part.
QUALIFIERS = set("area article bar block bottom box btn button buttons container entry fixed form global group holder icons "
                 "inner item items left link links list main mobile module outer page panel policy post posts primary "
                 "right row secondary section site slot sticky thread title top unit widget wrap wrapper zone".split())
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Frequent function words in English, French, German and Spanish.
STOP_WORDS = set(
    "a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their "
    "there they this to was we were which will with you "
    "au aux avec ce ces dans de des du elle en est et il ils la le les leur mais ne nous ou par pas plus pour qui que "
    "sa se ses son sont sur un une vous "
    "aber als am auch auf aus bei das dass dem den der die ein eine einem einen einer er es für hat ich ihr im ist mit "
    "nach nicht noch nur oder sich sie sind so über um und von vor war werden wie wir zu zum zur "
    "al como con del el ella ellos entre era esta este ha hay las lo los más me mi muy no nos para pero por porque sin "
    "sobre su sus también te tiene todo y ya yo".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
                    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([A-Za-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")


class Block:
    __slots__ = ("text", "links", "outside", "part", "heading", "hinted", "title", "label")

    def __init__(self, text: str, links: int, outside: bool, part: int, heading: bool, hinted: bool = False, title: bool = False):
        self.text, self.links, self.outside, self.part, self.heading = text, links, outside, part, heading
        self.title = title  # an h1
        self.hinted = hinted  # outside by nothing but a class or id
        self.label: bool | None = None


def _hints(names: str) -> set[str]:
    """Hints of a class or id: of words, and of compounds that hold nothing but hints and qualifiers."""
    out: set[str] = set()
    for token in names.split():
        parts = {w.lower() for w in _PART.findall(token.split("--")[0])}
        if parts & HINTS and parts <= HINTS | QUALIFIERS:
            out |= parts & HINTS
    return out


def _hidden_part(name: str, raw: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element is a part of the page that is not main text: for certain, by its class or id."""
    if name in OUTSIDE and not (inside and name == "header"):
        return True, False
    if not raw or name in ("html", "body"):
        return False, False
    found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(raw)}
    if found.get("role", "").lower() in ROLES or found.get("aria-hidden", "").lower() == "true":
        return True, False
    if re.search(r"(?:^|\s)hidden(?:\s|$|=)", raw) or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True, False
    words = _hints(found.get("class", "") + " " + found.get("id", ""))
    if name in INSIDE:
        words &= {"comment", "comments", "reply", "ad", "ads", "advert", "promo", "related", "teaser", "sponsored"}
    elif inside:
        words -= {"header"}
    return False, bool(words)


def blocks(page: str, opened: Collection[int] = ()) -> list[Block]:
    """All blocks with text, in page order; hints around the `opened` parts do not count."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # name, outside for certain, outside by a hint, inside
    open_: Counter[str] = Counter()  # names on the stack
    text: list[str] = []
    links = link_depth = part = 0
    heading = outside = hinted = inside = False
    at, end = 0, len(page)

    def close() -> None:
        nonlocal links
        shown = _SPACE.sub(" ", entities.unescape("".join(text))).strip() if text else ""
        if shown:
            out.append(Block(shown, links, outside or hinted, part if inside else 0, heading, hinted and not outside,
                             bool(open_["h1"])))
        text.clear()
        links = 0

    def add(piece: str) -> None:
        nonlocal links
        text.append(piece)
        if link_depth:
            links += len(_SPACE.sub(" ", entities.unescape(piece)).strip())

    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        if not name:
            continue
        closing, raw = m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        if name in SILENT and not closing:
            if not raw.endswith("/"):
                stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = stop.end() if stop else end
            continue
        if name == "a":
            link_depth = max(0, link_depth + (-1 if closing else 1))
        if name == "br":
            text.append(" ")
        if name not in BLOCK and name not in OUTSIDE:
            continue
        if name in INLINE and not open_["form"] and (name == "label" or open_["p"]):
            continue
        close()
        if closing:
            while open_[name]:
                top = stack.pop()[0]
                open_[top] -= 1
                if top == name:
                    break
        elif name not in VOID and not raw.endswith("/"):
            if name in ("p", "li", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == name:
                open_[stack.pop()[0]] -= 1
            if name in INSIDE and not inside:
                part += 1
            _, firm, hint, within = stack[-1] if stack else ("", False, False, False)
            if name == "main" or (name in INSIDE and not within and part in opened):
                hint = False
            own = _hidden_part(name, raw, within)
            open_[name] += 1
            stack.append((name, firm or own[0], hint or own[1], within or name in INSIDE))
        link_depth = 0 if name != "a" else link_depth
        _, outside, hinted, inside = stack[-1] if stack else ("", False, False, False)
        heading = any(x[0] in ("h1", "h2", "h3", "h4", "h5", "h6") for x in stack[-2:])
    close()
    return out


def lost_parts(found: list[Block]) -> set[int]:
    """Parts hidden by hints only that hold more text than all that is shown of the page."""
    shown, hidden = 0, Counter()
    for b in found:
        if not b.outside:
            shown += len(b.text) - b.links
        elif b.hinted and b.part:
            hidden[b.part] += len(b.text) - b.links
    return {part for part, n in hidden.items() if n > shown}


def _covered(found: list[Block]) -> bool:
    """Whether the long blocks of a page have stop words enough to be in a language of the list."""
    words = [w.lower() for b in found if not b.outside and len(b.text) >= SHORT and b.links <= LINKS * len(b.text)
             for w in _WORD.findall(b.text)]
    return sum(w in STOP_WORDS for w in words) >= COVERED * len(words)


def label(found: list[Block]) -> None:
    """Both passes: sets the label of every block."""
    framed = any(b.part and not b.outside for b in found)
    covered = framed or _covered(found)
    dense = [b.links > 0.5 * len(b.text) for b in found]
    for i, b in enumerate(found):
        n = len(b.text)
        density = b.links / n
        if b.outside or (framed and not b.part):
            b.label = False
        elif b.part and dense[i]:  # a link list, not a sentence that is a link
            beside = [j for j in (i - 1, i + 1) if 0 <= j < len(found) and found[j].part == b.part and not found[j].outside]
            b.label = False if any(dense[j] for j in beside) else None
        elif not b.part and (dense[i] or b.text.startswith(("©", "(c) ", "Copyright "))):
            b.label = False
        elif density > LINKS and not b.part:
            b.label = False
        elif n >= SHORT:
            words = [w.lower() for w in _WORD.findall(b.text)]
            stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
            if b.part or not covered or stops >= (STOP_HIGH if n < LONG else STOP_LOW):
                b.label = True
            elif b.links or n < LONG:
                b.label = False if not words else None
            else:
                b.label = None
    for part in {b.part for b in found}:
        _inherit([b for b in found if b.part == part and not b.outside])
    for b, after in zip(found, found[1:]):  # the title of an article that begins behind it
        if b.title and not b.outside and not b.part and after.part and not after.outside and framed:
            b.label = True


def _inherit(found: list[Block]) -> None:
    """Open blocks take the label of the nearest decided block; of two equally near ones that of text. A
    heading looks only ahead. Where nothing is decided, blocks inside an article or main part are text,
    and so are others that have no link."""
    decided = [(i, b.label) for i, b in enumerate(found) if b.label is not None]
    labels = []
    k = 0
    for i, b in enumerate(found):
        while k < len(decided) and decided[k][0] <= i:
            k += 1
        if b.label is not None:
            labels.append(b.label)
            continue
        before, after = decided[k - 1] if k else None, decided[k] if k < len(decided) else None
        if b.heading and after:
            before = None
        near = [(abs(i - x[0]), not x[1]) for x in (before, after) if x]
        labels.append(not min(near)[1] if near else bool(b.part) or not b.links)
    for b, x in zip(found, labels):
        b.label = x


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    if opened := lost_parts(found):
        found = blocks(page or "", opened)
    label(found)
    return "\n".join(b.text for b in found if b.label)


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """id, url, text and n_chars of every page; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                texts = [main_text(x) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=[id_column, url_column, "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_column, url_column)]
    return pages.select(id_column, url_column, F.col(html_column).cast("string")).mapInArrow(
        run, f"`{id_column}` {kinds[0]}, `{url_column}` {kinds[1]}, text string, n_chars long")
