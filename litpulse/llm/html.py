"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines: a block element starts a new line, and what cannot be
article text (scripts, menus, forms, marked adverts and so on) leaves empty lines in its
place. The lengths of a window of lines are summed at every line. A run of text begins where
the sum surges over a threshold and ends where it dives to nothing; the text between
surge and dive is kept, with the lines that adjoin the surge. A page that marks its article keeps
all of the article's lines; the sums are for pages that do not.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Lines of a window, and the empty lines that stand for what was stripped.
WINDOW = 3
#: A surge: the window's sum exceeds this part of the page's highest sum, and at most this many characters.
SURGE_SHARE = 0.1
SURGE_CHARS = 80

# Element names and words in class, id and role that mark what is not article text; layout words lift a mark.
RAW = "script style noscript template textarea title iframe object svg math canvas video audio select"
DROPPED = "head nav footer aside form button menu dialog fieldset"
BLOCKS = (
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul"
)
VOID = "area base br col embed hr img input link meta param source track wbr"
MARKS = (
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer disqus footer"
    " header login masthead menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo promoted promotion"
    " related replies respond share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget"
)
LAYOUT = "has with no without layout"
PLAIN = "html body article main header h1 h2 h3 h4 h5 h6"
ROLES = "banner navigation complementary contentinfo search menu menubar dialog alert alertdialog form"

_RAW, _DROPPED, _BLOCKS, _VOID = (frozenset(x.split()) for x in (RAW, DROPPED, BLOCKS, VOID))
_MARKS, _ROLES, _LAYOUT, _PLAIN = (frozenset(x.split()) for x in (MARKS, ROLES, LAYOUT, PLAIN))
_TAG = re.compile(r"<!--|<[!?]|</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_TAG_END = re.compile(r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>""")
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _marked(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element opens a part that is not article text."""
    if name in _DROPPED or (name == "header" and not in_article):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if attributes.get("role", "").lower() in _ROLES:
        return True
    if name in _PLAIN:
        return False
    for said in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = {w.lower() for w in _WORDS.findall(said)}
        if words & _MARKS and not words & _LAYOUT:
            return True
    return False


def strip_markup(page: str) -> list[tuple[str, bool, int]]:
    """Lines as ``(text, inside an article, characters of links)``; ``("", False, 0)`` where something was stripped."""
    lines: list[tuple[str, bool, int]] = []
    gap = [("", False, 0)] * WINDOW
    text: list[str] = []
    stack: list[tuple[str, bool]] = []
    depth: dict[str, int] = {}
    skipped, articles, links, linked = 0, 0, 0, 0

    def close_line() -> None:
        nonlocal text, linked
        if text:
            line = " ".join(references.unescape("".join(text)).split())
            if line:
                lines.append((line, articles > 0, linked))
            text, linked = [], 0

    def leave(name: str) -> None:
        """Close the innermost open element of a name and all within it; an unmatched end is ignored."""
        nonlocal skipped, articles, links
        if not depth.get(name):
            return
        while True:
            n, hides = stack.pop()
            depth[n] -= 1
            if n in ("article", "main"):
                articles -= 1
            elif n == "a":
                links -= 1
            if hides:
                skipped -= 1
                if not skipped:
                    lines.extend(gap)
            if n == name:
                return

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece and not skipped:
            text.append(piece)
            if links:
                linked += len(piece)
        if not m:
            break
        if m.group() == "<!--":
            end = page.find("-->", m.end())
            at = n if end < 0 else end + 3
            continue
        if m.group(1) is None:
            end = page.find(">", m.end())
            at = n if end < 0 else end + 1
            continue
        tail = _TAG_END.match(page, m.end())
        if tail is None:
            end = page.find(">", m.end())
            at = n if end < 0 else end + 1
        else:
            at = tail.end()
        name, inside = m.group(1).lower(), page[m.end() : at - 1]
        if name in _BLOCKS:
            close_line()
        if page[m.start() + 1] == "/":
            leave(name)
            continue
        if name in _RAW:
            if inside.endswith("/") and name not in ("script", "style", "title", "textarea"):
                continue
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = n if end is None else end.start()
            if end is not None:
                stop = page.find(">", at)
                at = n if stop < 0 else stop + 1
            continue
        if name in _VOID:
            continue
        # Elements whose end tag may be left out end where the next one begins.
        if name in ("li", "p", "dt", "dd", "option", "tr", "td", "th") and stack and stack[-1][0] == name:
            leave(name)
        attributes = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(inside)} if inside else {}
        hides = _marked(name, attributes, articles > 0)
        if hides:
            close_line()
            skipped += 1
        stack.append((name, hides))
        depth[name] = depth.get(name, 0) + 1
        if name in ("article", "main"):
            articles += 1
        elif name == "a":
            links += 1
    close_line()
    return lines


def window_sums(lengths: list[int], window: int = WINDOW) -> list[int]:
    """The text lengths of ``window`` lines from each line on."""
    total, out = sum(lengths[:window]), []
    for k in range(len(lengths)):
        out.append(total)
        total += (lengths[k + window] if k + window < len(lengths) else 0) - lengths[k]
    return out


def keep_between(lengths: list[int], window: int = WINDOW, share: float = SURGE_SHARE, chars: int = SURGE_CHARS) -> list[bool]:
    """Which lines lie between a surge and the dive that follows it."""
    sums = window_sums(lengths, window)
    level = min(chars, share * max(sums, default=0))
    kept, k, n = [False] * len(lengths), 0, len(lengths)
    while k < n:
        if not sums[k] or sums[k] <= level:
            k += 1
            continue
        surge = k
        # Lines before the surge that adjoin it belong to it.
        while surge and lengths[surge - 1] and not kept[surge - 1]:
            surge -= 1
        while k < n and sums[k]:
            k += 1
        for j in range(surge, k):
            kept[j] = lengths[j] > 0
    return kept


def main_text(page: str | None) -> str:
    """The article's blocks, one per line; empty where there is no text.

    With an ``article`` or ``main`` element that has text, its lines are all kept, and no others.
    Without one, a line that is mostly links counts as empty, and surge and dive decide.
    """
    lines = strip_markup(page or "")
    kept = [inside for _, inside, _ in lines]
    if not any(kept):
        kept = keep_between([len(t) if 2 * links <= len(t) else 0 for t, _, links in lines])
    return "\n".join(t for (t, _, _), keep in zip(lines, kept, strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``page_id, url, html``.

    Null or empty html: empty text. Repeated rows stay. Other columns are left out.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                schema=schema,
            )

    rows = pages.selectExpr("CAST(page_id AS BIGINT) AS page_id", "CAST(url AS STRING) AS url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
