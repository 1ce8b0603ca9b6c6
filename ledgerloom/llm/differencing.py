"""Main text of web pages by differencing pages with near urls.

Pages are sorted by host and path; each is held against the ``WITNESSES`` pages before it on its host
whose own text differs from its own and from each other's, or else those after it. The text lines of
two pages are aligned by a longest common subsequence, and the lines they share are the site's, not
the page's, and are deleted. Lines of an element that is made for such things (navigation, footers,
adverts, ...) are aligned by the element they are in, for their words may vary from page to page.

Two neighbours may well hold the same sentence of an article. So lines inside ``article`` or ``main``
that all witnesses of a page share are only votes: they are deleted where at least ``MIN_VOTES`` texts
of the host, and more than half of its texts, cast them for the same line. Two tag rules decide alone:
where a page has such an element the rest of the page is not its text, and elements made for
navigation and the like are left out even where no page is near.

Only hashes of lines are sorted and compared. Pages are parsed where they lie, once for these hashes
and once for the text; they are shuffled only if too many of them lose lines for a broadcast.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Container, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import sized, stored
from ledgerloom.llm.urls import host_and_path

# Elements by their part in a page.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "textarea", "select", "title")
ASIDE = frozenset("nav header footer aside form button dialog menu head".split())
MAIN = frozenset(("article", "main"))
WITNESSES = 2  # pages that a page is held against
MIN_VOTES = 3  # texts of a host that must share a line of main elements, beside being most of them
RANGE_LINES = 1_000_000  # lines of a range, about
INLINE = frozenset("a abbr b bdi bdo br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ASIDE_NAME = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|sidebar|menu|nav|navbar|breadcrumbs?|"
                         r"cookies?|consent|notice|popup|modal|newsletter|subscribe|share|social|related|comments?|replies|"
                         r"footer|header|masthead)(?:$|[\s_-])", re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<odd>/?)(?P<oddtag>[a-zA-Z][\w:-]*)[^>]*>"
    r"|<[!?/][^>]*>", re.S | re.I)
_SPACE = re.compile(r"\s+")


def lines(page: str) -> list[tuple[str, str, bool]]:
    """Text lines of a page: (text, element made for the likes of navigation that it is in, or '',
    whether it is in the main element)."""
    found: list[tuple[str, str, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, str, bool]] = [("", "", False)]  # tag, enclosing aside element, in main

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            found.append((text, stack[-1][1], stack[-1][2]))
        parts.clear()

    at = 0
    for token in _TOKEN.finditer(page):
        parts.append(page[at:token.start()])
        at = token.end()
        tag = (token["tag"] or token["oddtag"] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag in ("br", "wbr"):
                parts.append(" ")
            continue
        flush()
        if token["end"] or token["odd"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
        elif tag not in VOID and tag not in ("p", "li"):
            names = " ".join("".join(n) for n in _NAMES.findall(token["rest"] or ""))
            _, aside, main = stack[-1]
            if not aside and (tag in ASIDE or (tag not in ("html", "body") and _ASIDE_NAME.search(names))):
                aside = f"{tag} {names}".strip()
            stack.append((tag, aside, main or tag in MAIN))
    parts.append(page[at:])
    flush()
    return found


def aligned(a: list, b: list) -> list[int]:
    """Places of ``a`` in a longest common subsequence of two lists.

    The lists are cut to what they have in common; rows of the table are bit strings, so long lists
    cost a bit, not a cell, for each pair of lines.
    """
    both = set(a) & set(b)
    own = [i for i, x in enumerate(a) if x in both]
    other = [x for x in b if x in both]
    start = 0
    while start < min(len(own), len(other)) and a[own[start]] == other[start]:
        start += 1
    stop = 0
    while stop < min(len(own), len(other)) - start and a[own[-1 - stop]] == other[-1 - stop]:
        stop += 1
    middle, rest = own[start:len(own) - stop], other[start:len(other) - stop]
    places = own[:start] + own[len(own) - stop:]
    mask: dict = {}
    for j, x in enumerate(rest):
        mask[x] = mask.get(x, 0) | 1 << j
    full = (1 << len(rest)) - 1
    rows = [full]  # bit j of a row is 0 where the length grows at column j
    for i in middle:
        row = rows[-1]
        up = row & mask.get(a[i], 0)
        rows.append(((row + up) | (row - up)) & full)
    j = len(rest)
    for k in range(len(middle), 0, -1):
        def length(row: int) -> int:
            return j - (row & ((1 << j) - 1)).bit_count()
        if length(rows[k]) == length(rows[k - 1]):
            continue
        # The line is matched: step back to the column where its length is first reached.
        target = length(rows[k])
        low, high = 1, j
        while low < high:
            half = (low + high) // 2
            if half - (rows[k] & ((1 << half) - 1)).bit_count() >= target:
                high = half
            else:
                low = half + 1
        places.append(middle[k - 1])
        j = low - 1
    return sorted(places)


Lines = list[tuple[str, str, bool]]


def own_text(own: Lines) -> list[int]:
    """Places of the lines that the tag rules leave."""
    has_main = any(main and not aside for _, aside, main in own)
    return [i for i, (_, aside, main) in enumerate(own) if not aside and (main or not has_main)]


def line_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def main_text(own: Lines, dropped: Container[int] = ()) -> str:
    """The lines that the tag rules leave, without those at the places that are dropped."""
    return "\n".join(own[i][0] for i in own_text(own) if i not in dropped)


def mark(own: Lines) -> int | None:
    """Stands for the text of a page by the tag rules alone; None without text. Equal for true copies."""
    text = main_text(own)
    return line_hash(text) if text else None


ASIDE_LINE, MAIN_LINE, LEFT = 1, 2, 4  # flags of a line: made for navigation, in the main element, left by the tag rules
Hashed = tuple[list[int], list[int]]  # hashes and flags of the lines of a page


def hashed(own: Lines) -> Hashed:
    """What pages are compared by: for the likes of navigation the element, else the text."""
    left = set(own_text(own))
    return ([line_hash(f"aside {aside}" if aside else f"text {text}") for text, aside, _ in own],
            [ASIDE_LINE * bool(aside) + MAIN_LINE * main + LEFT * (i in left) for i, (_, aside, main) in enumerate(own)])


def shared_lines(own: Hashed, witnesses: list[Hashed]) -> tuple[list[int], list[int]]:
    """Places of lines to delete: those outside main elements that the first witness shares, and, if the
    host agrees, those inside that all witnesses share."""
    keys, flags = own
    left = {i for i, flag in enumerate(flags) if flag & LEFT}
    if not left or not witnesses:
        return [], []
    shared = left & set(aligned(keys, witnesses[0][0]))
    outside = sorted(i for i in shared if not flags[i] & MAIN_LINE)
    inside = {i for i in shared if flags[i] & MAIN_LINE}
    for other, _ in witnesses[1:]:
        if inside:
            inside &= set(aligned(keys, other))
    return outside, sorted(inside)


BEFORE, OWN, AFTER = 0, 1, 2  # a range's own pages, and those carried over from other ranges


def _hashes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for pages in batches:
        rows = []
        for page in pages:
            own = lines(page or "")
            rows.append((mark(own), *hashed(own)))
        yield pd.DataFrame(rows, columns=["mark", "keys", "flags"]).astype({"mark": "Int64"})


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    at = None  # range and host
    recent: list[tuple[int, Hashed]] = []  # the last pages of the host with different marks, newest first
    waiting: list[tuple] = []  # pages with too few witnesses yet: (key, mark, lines, witnesses)

    def decided(pages: list[tuple]) -> Iterator[tuple]:
        for key, of_own, own, witnesses in pages:
            outside, inside = shared_lines(own, witnesses)
            if outside or inside:
                yield *key, of_own, outside, inside, [own[0][i] for i in inside]

    def frame_of(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[*ORDER, "mark", "outside", "inside", "votes"])

    for frame in batches:
        rows: list[tuple] = []
        missing = frame["mark"].isna()
        for part, side, host, path, known, number, content, of_own, unmarked, keys, flags in zip(
                frame["part"], frame["side"], *(frame[c] for c in ORDER), frame["mark"], missing, frame["keys"], frame["flags"]):
            if (part, host) != at:
                rows += decided(waiting)
                at, recent, waiting = (part, host), [], []
            if unmarked:
                continue
            of_own, own = int(of_own), (list(keys), list(flags))
            # While pages wait, ``recent`` holds every mark of the host, so this is done a few times only.
            if waiting and all(m != of_own for m, _ in recent):
                for *_, witnesses in waiting:
                    witnesses.append(own)
                rows += decided([w for w in waiting if len(w[3]) == WITNESSES])
                waiting = [w for w in waiting if len(w[3]) < WITNESSES]
            if side == OWN:
                page = ((host, path, known, number, content), of_own, own, [x for m, x in recent if m != of_own][:WITNESSES])
                if len(page[3]) == WITNESSES:
                    rows += decided([page])
                else:
                    waiting.append(page)
            recent = [(of_own, own), *[r for r in recent if r[0] != of_own][:WITNESSES]]
        yield frame_of(rows)
    yield frame_of(list(decided(waiting)))


ORDER = ("host", "path", "known", "id", "content")
_KEY = "struct<host:string,path:string,known:boolean,id:bigint,content:bigint>"


def _bounds(marks: DataFrame, parts: int) -> DataFrame:
    """One row: keys that cut the pages in about ``parts`` ranges of like size."""
    share = min(1.0, 60 * parts / max(marks.count(), 1))
    found = [tuple(r) for r in marks.select(*ORDER).sample(share, 42).orderBy(*ORDER).collect()]
    cuts = [found[len(found) * i // parts] for i in range(1, parts)] if found else []
    return marks.sparkSession.createDataFrame([(sorted(set(cuts)),)], f"bounds array<{_KEY}>")


def _part(df: DataFrame, bounds: DataFrame) -> DataFrame:
    key = F.struct(*ORDER)
    return (df.crossJoin(F.broadcast(bounds))
            .withColumn("part", F.size(F.filter("bounds", lambda b: b <= key))).drop("bounds"))


def _carried(ranged: DataFrame) -> list[tuple]:
    """(part, side, *key) of the pages that a range needs from the ranges before and after it: the
    nearest with different marks on the host that the two have in common. A few rows a range."""
    ends = {r["part"]: (r["first"], r["last"]) for r in ranged.groupBy("part").agg(
        F.min("host").alias("first"), F.max("host").alias("last")).collect()}
    hosts = F.broadcast(ranged.sparkSession.createDataFrame(
        [(p, *e) for p, e in ends.items()], "part int, first string, last string"))
    key = F.struct(*ORDER)

    def nearest(end: str, pick: Column, order: Column) -> dict[int, list[tuple]]:
        """Per range, of its first or last host, one page for each mark, nearest to that end first."""
        ranks = F.row_number().over(Window.partitionBy("part").orderBy(order))
        found = (ranged.filter("mark IS NOT NULL").join(hosts, "part").filter(F.col("host") == F.col(end))
                 .groupBy("part", "mark").agg(pick.alias("key")).withColumn("rank", ranks)
                 .filter(F.col("rank") <= WITNESSES + 1).collect())
        by_part: dict[int, list[tuple]] = {}
        for r in sorted(found, key=lambda r: r["rank"]):
            by_part.setdefault(r["part"], []).append((r["mark"], tuple(r["key"])))
        return by_part

    tails = nearest("last", F.max(key), F.col("key").desc())
    heads = nearest("first", F.min(key), F.col("key").asc())

    def joined(one: list[tuple], more: list[tuple]) -> list[tuple]:
        marks = {m for m, _ in one}
        return [*one, *[x for x in more if x[0] not in marks]][:WITNESSES + 1]

    rows, host, state, seen = [], None, [], {}
    for part in sorted(ends):
        first, last = ends[part]
        state = state if host == first else []
        rows += [(part, BEFORE, *k) for _, k in state]
        host, state = last, joined(tails.get(part, []), state if first == last else [])
        seen[part] = len(state)
    host, state = None, []
    for part in sorted(ends, reverse=True):
        first, last = ends[part]
        state = state if host == last else []
        if seen[part] <= WITNESSES:  # else no page of the range still waits at its end
            rows += [(part, AFTER, *k) for _, k in state]
        host, state = first, joined(heads.get(part, []), state if first == last else [])
    return rows


SHARED = ("host string, path string, known boolean, id long, content long, mark long, outside array<int>, "
          "inside array<int>, votes array<long>")


def _site_lines(marks: DataFrame, shared: DataFrame) -> DataFrame:
    """(host, site): hashes of the lines in main elements that most texts of a host have as votes. No
    more than twice the lines of an average text, since each is in more than half of them."""
    votes = (shared.select("host", "mark", F.explode("votes").alias("line")).distinct()
             .groupBy("host", "line").agg(F.count("*").alias("votes")).filter(F.col("votes") >= MIN_VOTES))
    voters = (marks.filter("mark IS NOT NULL").select("host", "mark").distinct()
              .groupBy("host").agg(F.count("*").alias("texts")))
    return (votes.join(voters, "host").filter(2 * F.col("votes") > F.col("texts"))
            .groupBy("host").agg(F.collect_list("line").alias("site")))


def _dropped(marks: DataFrame, shared: DataFrame) -> DataFrame:
    """Page keys and the places of the lines that go, for pages that lose any."""
    agreed = F.filter(F.arrays_zip("inside", "votes"),
                      lambda v: F.array_contains("site", v["votes"]))
    places = F.concat("outside", F.when(F.col("site").isNull(), F.array().cast("array<int>")).otherwise(
        F.transform(agreed, lambda v: v["inside"])))
    return (shared.join(_site_lines(marks, shared), "host", "left")
            .select(*ORDER, places.alias("dropped")).filter("size(dropped) > 0").dropDuplicates(list(ORDER)))


def _texts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for pages, places in batches:
        yield pd.Series([main_text(lines(page or ""), () if gone is None else set(gone))
                         for page, gone in zip(pages, places)], dtype="object")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars, one row per row of ``pages``.

    Null and empty html give an empty text. Pages without a near page lose only what the tag rules
    take. A host of any size is sorted in as many ranges as it needs; the pages that a range needs
    from its neighbours are carried over, so results do not depend on the ranges. Pages of one url
    follow each other by id, then content. An empty table gives no rows; other columns are not read.
    """
    spark = pages.sparkSession
    host, path = host_and_path("url")
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"),
                         path.alias("path"), F.xxhash64("html").alias("content"))
    keyed = (keyed.withColumn("known", F.col("page_id").isNotNull())
             .withColumn("id", F.coalesce("page_id", F.lit(0).cast("long"))))
    parsed = F.pandas_udf(_hashes, "mark long, keys array<long>, flags array<int>").asNondeterministic()
    marks = stored(keyed.select(*ORDER, parsed("html").alias("found")).select(*ORDER, "found.*"), "marks")
    n_lines = marks.agg(F.sum(F.size("keys")).alias("n")).first()["n"] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_lines // RANGE_LINES + 1)
    bounds = _bounds(marks, parts)
    ranged = _part(marks, bounds)
    carried = spark.createDataFrame(
        _carried(ranged), "part int, side int, host string, path string, known boolean, id long, content long")
    columns = ("part", "side", *ORDER, "mark", "keys", "flags")
    others = marks.join(F.broadcast(carried), list(ORDER)).select(*columns).dropDuplicates(["part", "side", *ORDER])
    everything = ranged.withColumn("side", F.lit(OWN)).select(*columns).unionByName(others)
    shared = stored(everything.repartitionByRange(parts, "part").sortWithinPartitions("part", "side", *ORDER)
                    .mapInPandas(_compare, SHARED), "shared")
    dropped = stored(_dropped(marks, shared), "dropped")
    size = dropped.agg(F.sum(
        F.octet_length("host") + F.octet_length("path") + 4 * F.size("dropped") + 64).alias("bytes")).first()["bytes"]
    text = F.pandas_udf(_texts, "string").asNondeterministic()
    return (keyed.join(sized(dropped, 1, size or 0), list(ORDER), "left")
            .select("page_id", "url", text("html", "dropped").alias("text"))
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))
