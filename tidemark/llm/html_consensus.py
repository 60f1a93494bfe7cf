"""HTML extraction by consensus paths of a host.

Each page's containers are scored by the text blocks that they hold, links and boilerplate left out, and
the page votes for its best container's path: tags with generalised classes (digits as #). Spark counts
the votes of each host. Pages are then extracted again from the elements that stand on a winning path of
their host; a page that has none is extracted from its own best container.

Left out everywhere: navigation, page headers and footers, asides, forms, scripts, styles, hidden parts,
and elements whose class, id or role says advert, sidebar, menu, notice, comments and the like.

Defined results: null or empty html and pages without text give empty text; malformed markup is read to
its end (open elements end with their parent; text outside any element belongs to the body); repeated
pages are extracted each; null urls share one empty host. Each page is parsed in one sweep, whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .host_trust import split_url

#: The most hosts, and characters of their winning paths, that are broadcast; beyond them they are joined by a
#: shuffle, whose large hosts Spark splits.
BROADCAST_HOSTS = 200_000
BROADCAST_CHARS = 64 << 20
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"'<]++|"[^"<]*"|'[^'<]*'|["'])*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
LEFT_OUT = frozenset("head nav footer aside form script style template noscript iframe button select textarea svg canvas object dialog menu title input label audio video map".split())
CONTENT = frozenset(("article", "main"))
#: Words in a class name, id or role that mark an element as no part of the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion promoted "
    "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices banner banners popup "
    "modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus respond reply replies footer masthead "
    "share sharing social related recommended recommendations widget widgets toolbar pagination pager skip contentinfo complementary search alert "
    "dialog feedback reactions".split()
)
#: Those that count on elements within a line of text.
INLINE_MARKS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored share sharing social".split())
#: A class name that starts so speaks of a layout, not of the element.
LAYOUT = frozenset("has with no without main content page site is not".split())
WORD = re.compile(r"[a-z]+")


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}


def marked(tag: str, own: dict[str, str], inside: bool) -> bool:
    """Whether the element's class, id or role says that it's no part of the article."""
    if "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", ""):
        return True
    if tag in ("html", "body", "main"):
        return False
    marks = MARKS if tag in BLOCK else INLINE_MARKS
    for name in f"{own.get('class', '')} {own.get('id', '')} {own.get('role', '')}".split():
        words = WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
        if words and words[0] not in LAYOUT and (marks.intersection(words) or not inside and tag not in CONTENT and words[-1] == "header"):
            return True
    return False


def step(tag: str, own: dict[str, str]) -> str:
    """A tag with its generalised classes."""
    names = sorted({re.sub(r"\d+", "#", x.lower()) for x in own.get("class", "").split()})
    return ".".join([tag, *names])


class Element:
    __slots__ = ("tag", "path", "out", "inside", "link")

    def __init__(self, tag: str, path: str, out: bool, inside: str, link: bool) -> None:
        self.tag, self.path, self.out, self.inside, self.link = tag, path, out, inside, link


def blocks_of(page: str) -> list[tuple[str, str, str, int]]:
    """Text blocks in page order: text, path of the block's container, path of its parent, characters in links."""
    found: list[tuple[str, str, str, int]] = []
    root = Element("", "", False, "", False)
    stack, held, linked, owner = [root], [], 0, None
    at, n = 0, len(page)

    def text(a: int, b: int) -> None:
        nonlocal linked, owner
        top = stack[-1]
        if a < b and not top.out:
            chunk = page[a:b]
            held.append(chunk)
            if not chunk.isspace():
                owner = owner or next((e for e in reversed(stack) if e.tag in BLOCK or not e.tag))
                linked += len(chunk) if top.link else 0

    def close() -> None:
        nonlocal linked, owner
        if held:
            line = " ".join(html.unescape("".join(held)).split())
            if line:
                box = owner or root
                # of a paragraph or the like, the container is what holds it
                chain = box.path.split(">")
                if box.inside:
                    found.append((line, box.inside, "", linked))
                else:
                    depth = len(chain) - (box.tag in ("p", "li", "pre", "blockquote", "dd", "dt", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "figcaption"))
                    found.append((line, ">".join(chain[: max(depth, 0)]), ">".join(chain[: max(depth - 1, 0)]), linked))
            held.clear()
        linked, owner = 0, None

    while True:
        m = TAG.search(page, at)
        if not m:
            text(at, n)
            break
        text(at, m.start())
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            held.append(" ")
            continue
        if m[1]:  # an end tag
            if tag in BLOCK:
                close()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in BLOCK and (tag not in BLOCK or tag in ("p", "li") and stack[i].tag not in ("p", "li")):
                    break
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in BLOCK:
            close()
        if tag in VOID:
            continue
        if tag == "html":
            del stack[1:]  # another document begins
        elif tag == "body":
            while len(stack) > 1 and stack[-1].tag != "html":
                stack.pop()
        elif tag in BLOCK:
            for i in range(len(stack) - 1, 0, -1):
                kind = stack[i].tag
                if kind == "p" or tag == kind and tag in ("li", "option", "tr", "td", "th", "dt", "dd") or {tag, kind} in ({"dt", "dd"}, {"td", "th"}):
                    del stack[i:]
                    break
                if kind in BLOCK:
                    break
        top = stack[-1]
        raw = m[3]
        own = attributes(raw) if raw and not raw.isspace() else {}
        out = top.out or tag in LEFT_OUT or tag == "header" and not top.inside or bool(own) and marked(tag, own, bool(top.inside))
        path = top.path
        if tag in BLOCK:
            path = f"{path}>{step(tag, own)}" if path else step(tag, own)
        inside = top.inside or (path if tag in CONTENT else "")
        if tag == "article" and not top.inside.rpartition(">")[2].startswith("article"):
            inside = path
        stack.append(Element(tag, path, out, inside, top.link or tag == "a"))
    close()
    return found


def container_scores(blocks: list[tuple[str, str, str, int]]) -> dict[str, float]:
    """Scores of a page's container paths: length, sentences, and little text in links."""
    scores: dict[str, float] = {}
    for line, path, parent, linked in blocks:
        plain = max(0.0, 1 - linked / max(1, len(line)))
        score = plain * (1 + min(len(line) / 100, 30) + line.count(",") * 0.5 + line.count(". ") * 0.5)
        if len(line) < 25:
            score *= 0.25
        scores[path] = scores.get(path, 0.0) + score
        if parent:
            scores[parent] = scores.get(parent, 0.0) + score / 2
    return scores


def climb(blocks: list[tuple[str, str, str, int]], path: str) -> str:
    """The container around the best one, as long as what else it holds is less, and text rather than links: a heading
    or a lead that stands beside the paragraphs. Bodies are never taken."""
    while (parent := path.rpartition(">")[0]) and parent.rpartition(">")[2].partition(".")[0] not in ("body", "html"):
        under = [b for b in blocks if b[1] == parent or b[1].startswith(f"{parent}>")]
        own = sum(len(line) for line, at, _, _ in under if at == path or at.startswith(f"{path}>"))
        others = [b for b in under if b[1] != path and not b[1].startswith(f"{path}>")]
        size = sum(len(b[0]) for b in others)
        if size > own or sum(b[3] for b in others) > 0.3 * size:
            break
        path = parent
    return path


def best_path(blocks: list[tuple[str, str, str, int]]) -> str | None:
    scores = container_scores(blocks)
    if not scores:
        return None
    best = max(scores, key=lambda p: (scores[p], -len(p), p))
    return best if any(inside == best for _, inside, parent, _ in blocks if not parent) else climb(blocks, best)


def text_at(blocks: list[tuple[str, str, str, int]], paths: list[str]) -> str:
    """Blocks on or below the paths, in page order."""
    wanted, below = set(paths), tuple(f"{p}>" for p in paths if p)
    return "\n".join(line for line, path, _, _ in blocks if path in wanted or below and path.startswith(below))


def extract_page(page: str | None, paths: list[str] | None) -> str:
    blocks = blocks_of(page or "")
    out = text_at(blocks, paths) if paths else ""
    if not out and (own := best_path(blocks)) is not None:
        out = text_at(blocks, [own])
    return out


def host_paths(pages: DataFrame, share: float = 0.2) -> DataFrame:
    """Winning paths per host: the one with most votes, and all with at least `share` of the host's votes."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"host": batch["host"], "path": [best_path(blocks_of(x or "")) for x in batch["html"]]})

    host, _ = split_url(F.col("url"))
    votes = pages.select(host.alias("host"), "html").mapInPandas(vote, "host string, path string").where(F.col("path").isNotNull()).groupBy("host", "path").agg(F.count("*").alias("n"))
    whole = votes.groupBy("host").agg(F.sum("n").alias("all"), F.max_by("path", F.struct("n", "path")).alias("first"))
    chosen = votes.join(whole, "host").where((F.col("path") == F.col("first")) | (F.col("n") >= share * F.col("all")))
    return chosen.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("paths"))


def extract_main_text(pages: DataFrame, share: float = 0.2, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    from .common import cut

    kinds = dict(pages.dtypes)
    winners = cut(host_paths(pages, share))
    found = winners.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length(F.array_join("paths", ""))), F.lit(0)).alias("chars")).first()
    small = found["n"] <= broadcast_hosts and found["chars"] <= BROADCAST_CHARS
    host, _ = split_url(F.col("url"))
    # ids travel as text: whole numbers with nulls would become floating point
    own = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", host.alias("host")).join(F.broadcast(winners) if small else winners, "host", "left")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [extract_page(x, None if p is None else list(p)) for x, p in zip(batch["html"], batch["paths"], strict=True)]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = own.select("page_id", "url", "html", "paths").mapInPandas(extract, f"page_id string, url {kinds['url']}, text string, n_chars long")
    return rows.withColumn("page_id", F.col("page_id").cast(kinds["page_id"]))
