"""Alignment against the textbook table; pages with known main text."""

import random
import re

import inputs
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import differencing
from ledgerloom.llm.common import table


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from("abcdx"), max_size=14), st.lists(st.sampled_from("abcdy"), max_size=14))
def test_alignment_is_longest(a, b):
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1], size[i + 1][j])
    places = differencing.aligned(a, b)
    rest = iter(b)
    assert len(places) == size[-1][-1] and all(a[i] in rest for i in places)


def text_of(page):
    return differencing.main_text(differencing.lines(page))


def test_pages():
    assert text_of("<body><p>One  two\n three<p>four &amp; five<br>six</body>") == "One two three\nfour & five six"
    assert text_of("<nav>x</nav><article><h1>T</h1><p>a<script>var t='</p>';</script> b</p><aside>y</aside></article><footer>z</footer>") == "T\na b"
    assert text_of("<div class='cookie-notice'>c</div><div id=main><p>text</div><div class=comments>no</div>") == "text"
    assert text_of("<p title='a>b'>x<!-- <p>y --></p><style>p{}</style>&copy; &#233;&lt;") == "x\n© é<"
    assert text_of("<form>f</form><p>unclosed <b>bold") == "unclosed bold"
    assert text_of("") == "" and text_of("plain < text & more") == "plain < text & more"


def test_shared_lines_go_and_own_lines_stay(spark):
    frame = "<div>Site of sites</div>{}<div>All about us</div>"
    rows = [(i, f"http://h.org/p/{i}", frame.format(f"<p>story {i}</p><p>end {i}</p>")) for i in range(6)]
    rows += [(10, "http://alone.org/x", frame.format("<p>story</p>")), (11, None, None), (12, "", ""),
             (13, "http://h.org/p/1", rows[1][2]), (None, "http://z.org/", "<p>q</p>")]
    got = {r.page_id: r for r in differencing.extracted(inputs.pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert got[0].text == "story 0\nend 0" and got[5].text == "story 5\nend 5"
    assert got[10].text == "Site of sites\nstory\nAll about us"
    assert got[11].text == got[12].text == "" and got[11].n_chars == 0 and got[None].text == "q"
    assert differencing.extracted(inputs.pages(spark, rows).limit(0)).count() == 0


def test_copied_articles_keep_their_text(spark):
    page = "<nav>menu</nav><article><p>the same story</p></article>"
    rows = [(i, f"http://h.org/{i}", page) for i in range(3)]
    assert {r.text for r in differencing.extracted(inputs.pages(spark, rows)).collect()} == {"the same story"}


def test_long_lists_of_lines_take_no_time():
    a, b = ["x", "y"] * 4000, ["y", "z", "x"] * 3000
    assert len(differencing.aligned(a, b)) >= 6000


def test_given_pages_hold_whole_documents(spark):
    pages, docs = (table(spark, "/root/testdata/sf0.01", t) for t in ("pages", "documents"))
    bodies = {r.page_id: re.search("<article>(.*)</article>", r.html, re.S)[1] for r in pages.collect()}
    for r in differencing.extracted(pages).collect():
        assert r.n_chars == len(r.text) and r.text.count("\n") + 1 == len(
            [x for x in re.split(r"</?(?:p|h1)>", bodies[r.page_id]) if re.sub("<[^>]*>", "", x).strip()])


def test_site_lines_inside_articles_go_and_copies_stay(spark):
    page = "<article><p>Share this</p><p>{}</p><p>Write to our paper</p></article>"
    rows = [(i, f"http://h.org/{i:02}", page.format(f"story {i}")) for i in range(5)]
    rows += [(i, f"http://h.org/{i:02}", page.format("told again")) for i in range(5, 10)]  # true copies
    rows += [(10, "http://h.org/10", page.format("long</p><p>tale</p><p>one")), (11, "http://h.org/11", page.format("long</p><p>tale</p><p>two")),
             (12, "http://h.org/12", ""), (13, "http://h.org/13", page.format("last"))]
    got = {r.page_id: r.text for r in differencing.extracted(inputs.pages(spark, rows)).collect()}
    assert got == {**{i: f"story {i}" for i in range(5)}, **{i: "told again" for i in range(5, 10)},
                   10: "long\ntale\none", 11: "long\ntale\ntwo", 12: "", 13: "last"}


def plain(pages):
    """Texts by a plain reading: every pair of texts of a host in order, the textbook alignment, all votes."""
    def in_common(a, b):
        size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1], size[i + 1][j])
        return size

    def always_matched(a, b):
        """Places of ``a``; only lists with one alignment are given to this."""
        size, i, j, places = in_common(a, b), len(a), len(b), set()
        while i and j:
            if a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
                places.add(i)
            elif size[i - 1][j] >= size[i][j - 1]:
                i -= 1
            else:
                j -= 1
        return places

    order = sorted(range(len(pages)), key=lambda n: (pages[n][1].split("/", 3)[2], "/" + pages[n][1].split("/", 3)[3], pages[n][0]))
    read = {n: differencing.lines(pages[n][2]) for n in order}
    told = {n: text_of(pages[n][2]) for n in order}
    gone, votes = {n: [set(), set()] for n in order}, {}
    for place, n in enumerate(order):
        site = pages[n][1].split("/", 3)[2]
        near = []
        for other in [*order[:place][::-1], *order[place + 1:]]:
            if pages[other][1].split("/", 3)[2] == site and told[other] and told[other] not in (
                    told[n], *(told[w] for w in near)) and len(near) < 2:
                near.append(other)
        if told[n] and near:
            keys = {m: [(aside or text, bool(aside)) for text, aside, _ in read[m]] for m in (n, *near)}
            common = [always_matched(keys[n], keys[m]) for m in near]
            left = set(differencing.own_text(read[n]))
            gone[n] = [{i for i in common[0] & left if not read[n][i][2]},
                       {i for i in set.intersection(*common) & left if read[n][i][2]}]
            for i in gone[n][1]:
                votes.setdefault((site, read[n][i][0]), set()).add(told[n])
    found = {}
    for n in order:
        site = pages[n][1].split("/", 3)[2]
        texts = {told[m] for m in order if pages[m][1].split("/", 3)[2] == site and told[m]}
        agreed = {i for i in gone[n][1] if len(votes[site, read[n][i][0]]) >= 3 and 2 * len(votes[site, read[n][i][0]]) > len(texts)}
        found[pages[n][0]] = "\n".join(read[n][i][0] for i in differencing.own_text(read[n]) if i not in gone[n][0] | agreed)
    return found


def test_pairing_and_votes_against_a_plain_reading(spark):
    rng = random.Random(5)
    rows = []
    for i in range(150):
        site = rng.randrange(6)
        own = [f"story {rng.randrange(4)} of {site}", f"end {rng.randrange(3)}"]
        body = ["Share this"] * (site % 2) + own + ["About us"] * (site > 1)
        inner = "".join(f"<p>{x}</p>" for x in body)
        page = [f"<div>Top</div>{inner}<div>Last</div>", f"<nav>m{i}</nav><article>{inner}</article><div>x</div>"][site > 2]
        rows.append((i, f"http://h{site}.org/{rng.randrange(40):02}", page if rng.random() < 0.95 else ""))
    got = {r.page_id: r.text for r in differencing.extracted(inputs.pages(spark, rows)).collect()}
    want = plain(rows)
    assert got == want
    assert any("Share" in r[2] and "Share" not in want[r[0]] for r in rows)


def test_sentences_that_two_neighbours_hold_stay(spark):
    page = "<article><h1>{}</h1><p>A sentence they share.</p><p>{}</p></article>"
    other = "<article><p>other {}</p></article>"
    rows = [(i, f"http://h.org/{i}", page.format("Title", i)) for i in range(3)]
    rows += [(i, f"http://h.org/{i}", other.format(i)) for i in range(3, 9)]
    got = {r.page_id: r.text for r in differencing.extracted(inputs.pages(spark, rows)).collect()}
    assert [got[i] for i in range(3)] == [f"Title\nA sentence they share.\n{i}" for i in range(3)]


def test_no_sentence_of_the_given_articles_goes(spark):
    pages = table(spark, "/root/testdata/sf0.1", "pages")
    got = {r.page_id: r.text for r in differencing.extracted(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id] == text_of(r.html)


def test_very_long_pages(spark):
    long = "<article>" + "".join(f"<p>line {i} {{0}}</p>" for i in range(30_000)) + "<p>the end</p></article>"
    rows = [(i, f"http://h.org/{i}", long.format(i)) for i in range(3)]
    got = differencing.extracted(inputs.pages(spark, rows)).collect()
    assert len(got) == 3 and all(r.text.count("\n") >= 29_999 and r.n_chars == len(r.text) for r in got)


def test_pairs_do_not_depend_on_ranges(spark):
    page = "<div>Share {}</div><p>{}</p><div>All about us</div>"
    rows = [(i, f"http://h{i // 9}.org/{i:02}", page.format(i % 2, f"story {i // 2 if i < 18 else 0}")) for i in range(40)]
    before, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in (1, 7, 60):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got.append({r.page_id: r.text for r in differencing.extracted(inputs.pages(spark, rows)).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1] == got[2] and len(got[0]) == 40 and not any("us" in t for t in got[0].values())
