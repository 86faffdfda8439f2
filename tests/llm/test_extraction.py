import random

from sabermill.llm.extraction import extract, main_text, range_bounds, shared_lines
from sabermill.llm.html_lines import ARTICLE, MAIN, OPEN, lines_of

SCHEMA = "page_id long, url string, html string, text string, host string"
FRAME = "<html><head><title>T</title><style>p{{}}</style><script>var t='<p>no</p>';</script></head><body>{}</body></html>"


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    draw = random.Random(1)
    for _ in range(800):
        a, b = ([draw.choice("abcd") for _ in range(draw.randint(0, 14))] for _ in "ab")
        found = shared_lines(a, b)
        rest = iter(b)
        assert found == sorted(set(found)) and len(found) == lcs(a, b) and all(a[i] in rest for i in found)


def test_markup():
    page = FRAME.format(
        "<header>site</header><nav><ul><li>menu</li></ul></nav><!-- c --><div class='ad box'>buy<div>now</div></div>loose"
        "<article><h1>A &amp; B&copy</h1><p>one <b>t</b>wo<br>three&nbsp;\n four<form>f</form><p title='a>b'>five<aside>side</aside>"
        "<div id=comments>c1<p>c2</div><ul><li>six</ul><textarea>raw <p></textarea></article><footer>end"
    )
    assert lines_of(page) == [("loose", OPEN), *[(t, ARTICLE) for t in ("A & B©", "one two", "three four", "five", "six")]]
    assert lines_of("<main>x<article>y</article></main>z") == [("x", MAIN), ("y", ARTICLE), ("z", OPEN)]
    assert lines_of("<p hidden>h</p><p role=alert>a<p>b") == [("a", OPEN), ("b", OPEN)]
    assert lines_of("a<nav>b</nav>c<div class=cookie-notice>d") == [("a", OPEN), ("c", OPEN)]
    for odd in (None, "", "<", "<p", "&", "<!--", "<script>", "</p></div></article>", "<article>", "a < b"):
        lines_of(odd)
    assert lines_of("a < b") == [("a < b", OPEN)]
    assert lines_of("<article>t<nav>n</article>u") == [("t", ARTICLE), ("u", OPEN)]


def test_articles_keep_shared_lines_and_open_pages_lose_them():
    lines = [("menu", OPEN), ("own", OPEN), ("end", OPEN)]
    assert main_text(lines, [("menu", OPEN), ("other", OPEN), ("end", OPEN)]) == ("own", 2)
    assert main_text(lines, None) == ("menu own end", 0)
    marked = [("menu", OPEN), ("same", ARTICLE), ("end", OPEN)]
    assert main_text(marked, marked) == ("same", 2)


def page(i, style):
    body = f"<p>text {i} one</p><p>shared by chance</p>" if style == "article" else f"<div>Home</div><div>About</div><p>text {i} one</p><div>Copyright</div>"
    return FRAME.format(f"<article>{body}</article>" if style == "article" else body)


def test_pages_of_a_host_are_compared_in_order(spark):
    rows = [(i, f"http://{'Open' if i % 2 else 'open'}.example/{i:03d}?q={i}", page(i, "open"), "mine", "h") for i in range(60)]
    rows += [(100 + i, f"http://art.example/{i}", page(i, "article"), None, None) for i in range(20)]
    rows += [(200, "http://alone.example/", page(200, "open"), None, None), (201, None, page(201, "open"), None, None), (202, None, page(201, "open"), None, None)]
    rows += [(203, "http://none.example/", None, None, None), (204, "http://none.example/x", "", None, None), (205, "http://big.example/", FRAME.format("<p>w</p>" * 30_000), None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for range_bytes in (1 << 20, 9000):
        done = extract(df, range_bytes=range_bytes)
        assert done.columns == ["page_id", "url", "text", "n_chars", "n_shared", "host"]
        got = {r["page_id"]: r for r in done.collect()}
        assert len(got) == len(rows) and all(got[i]["url"] == u for i, u, *_ in rows)
        assert all(r["n_chars"] == len(r["text"]) for r in got.values())
        for i in range(60):
            assert got[i]["text"] == f"text {i} one" and got[i]["n_shared"] == 3
        for i in range(20):
            assert got[100 + i]["text"] == f"text {i} one shared by chance"
        assert got[200]["text"] == "Home About text 200 one Copyright" and got[201]["text"] == got[202]["text"] == "Home About text 201 one Copyright"
        assert got[203]["text"] == got[204]["text"] == "" and got[205]["n_chars"] == 59_999


def test_small_batches_and_no_pages(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(i, f"http://h{i // 7}.example/{i:03d}", page(i, "open"), None, None) for i in range(40)]
        got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, SCHEMA), range_bytes=3000).collect()}
        assert got == {i: f"text {i} one" for i in range(40)}
        assert extract(spark.createDataFrame([], SCHEMA)).collect() == []
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_a_bound_leaves_two_pages_of_a_host_on_either_side():
    keys = sorted([("big", f"big\0{i:03d}") for i in range(40)] + [(f"h{i:02d}", f"h{i:02d}\0x") for i in range(30)])
    bounds = range_bounds(keys, 12)
    assert 8 <= len(bounds) <= 11 and any(b.startswith("big\0") for b in bounds)
    for bound in bounds:
        below = [k for h, k in keys if k < bound and h == bound.split("\0")[0]]
        above = [k for h, k in keys if k >= bound and h == bound.split("\0")[0]]
        assert len(below) == 0 or min(len(below), len(above)) >= 2
    assert range_bounds([], 3) == [] and range_bounds(keys[:2], 5) == []


def test_the_text_does_not_depend_on_the_ranges(spark):
    draw = random.Random(6)
    rows = []
    for i in range(300):
        host = draw.choice(["a.example"] * 6 + ["b.example", "c.example", f"d{i}.example"])
        lines = "".join(f"<p>{draw.choice(['menu', 'about', 'terms', 'news', f'own {i}'])}</p>" for _ in range(12))
        rows.append((i, f"http://{host}/{draw.randint(0, 400)}", lines, None, None))
    df = spark.createDataFrame(rows, SCHEMA)
    texts = lambda pages, size: {r["page_id"]: (r["text"], r["n_shared"]) for r in extract(pages, range_bytes=size).collect()}
    whole = texts(df, 1 << 30)
    assert len(whole) == 300
    for size in (40_000, 9000, 4000, 1500, 400):
        assert texts(df.repartition(3), size) == whole, size
