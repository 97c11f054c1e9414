import base64
import bz2
import gzip
import io
import lzma
import math
import re
import tarfile
import time
import zlib
from collections import Counter
from urllib.parse import quote

import pytest
import zstandard

from roomtide.llm import html_text, quality_classifier, quality_rules, secret_scan


def test_main_text_of_generated_pages(spark):
    for r in html_text.extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).join(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html"), "page_id").collect():
        from html import unescape

        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        lines = [" ".join(unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)\b[^>]*>", article)]
        assert r.text == "\n".join(x for x in lines if x) and r.n_chars == len(r.text)


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>a &amp; b&nbsp;c<p>d<br>e", "a & b c\nd\ne"),
    ("<nav><a href=x>menu</a></nav><div class='cookie-notice'>we use cookies.</div><main><h1>T</h1><p>One, two. Three.</p><form>name</form></main><footer>foot.</footer>", "T\nOne, two. Three."),
    ("<article><p>Real text, here.</p><div class=comments><p>first!</p></div><script>var a='</p>';</script></article>", "Real text, here."),
    ("<article><ul><li>one<li>two</ul></article><aside>side, bar.</aside>", "one\ntwo"),
    ("<div>" * 2000 + "deep" + "</div>" * 2000, "deep"), ("<p" * 20000, "<p" * 20000),
])
def test_page_shapes(html, text):
    assert html_text.main_text(html) == text


LONG = "Some words of a long paragraph, and more of them, make a sentence of the article. " * 3


@pytest.mark.parametrize("html, kept, gone", [
    (f"<article><h1>A short title</h1><p>{LONG}</p><div class=zz9>Read more stories</div><ul class=q7><li><a href=x>a link</a><li><a href=y>a link</a></ul><p>{LONG}</p></article>", ["A short title"], ["Read more", "a link"]),
    (f"<article><h1><a href=x>A linked title</a></h1><div class=body><p>{LONG}</p></div></article>", ["A linked title"], []),
    (f"<div class=text><p>{LONG}</p><ul><li>fifteen letters</li><li>two of them</li></ul><table><tr><td>cell 1</td><td>cell 2</td></tr></table></div><div class=q>Legal</div>", ["fifteen letters", "two of them", "cell 1", "cell 2"], ["Legal"]),
    (f"<div class=text><p>{LONG}</p><div class=wide><table><tr><td>cell 1</td></tr></table></div></div>", ["cell 1"], []),
    (f"<div class='page sidebar left' id=search-page><p>{LONG}</p></div><div class=q>All pages, one.</div>", ["Some words"], []),
    (f"<article><p>{LONG}</p><div class=comments><p>{LONG.replace('article', 'comment')}</p></div></article>", ["article"], ["comment"]),
    (f"<form><p>{LONG}</p></form><div class=q>Legal</div>", ["Some words"], []),
])
def test_ratios_decide_all_paths(html, kept, gone):
    text = html_text.main_text(html)
    assert LONG.strip() in text and all(x in text for x in kept) and not any(x in text for x in gone)


def test_page_rows_are_kept(spark):
    rows = [(1, None, None), (1, "u", "<p>x, y."), (None, "u", "<p>x, y."), (1, "u", "<p>x, y.")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, text string")
    assert sorted((r.text, r.n_chars) for r in html_text.extract(df).collect()) == [("", 0)] + [("x, y.", 5)] * 3
    assert html_text.extract(df.where("false")).count() == 0


SECRET = "password=hunter2secret"


@pytest.mark.parametrize("wrapped", [
    SECRET, quote(SECRET), quote(quote(SECRET)), base64.b64encode(SECRET.encode()).decode(), base64.b64encode(gzip.compress(SECRET.encode())).decode(),
    base64.b64encode(zlib.compress(base64.b64encode(SECRET.encode()))).decode(), "".join(f"\\u{ord(c):04x}" for c in SECRET), "".join(f"&#{ord(c)};" for c in SECRET),
])
def test_layers_map_back_to_the_text(wrapped):
    base, every = secret_scan.scan(f"é 😀 {wrapped} end")
    assert (4, 4 + len(wrapped), 0) in every
    assert (base == every) == (wrapped == SECRET)
    assert secret_scan.masked(f"é 😀 {wrapped} end", every) == "é 😀 [SECRET] end"


def _many(compress, n=3):
    return b"".join(compress(x) for x in [b"first member, " * 40, SECRET.encode(), b" last member"][:n])


@pytest.mark.parametrize("compress", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_all_members_and_streams_are_read(compress):
    wrapped = base64.b64encode(_many(compress)).decode()
    assert (4, 4 + len(wrapped), 0) in secret_scan.scan(f"é 😀 {wrapped} end")[1]
    halves = compress(SECRET[:12].encode()) + compress(SECRET[12:].encode())
    wrapped = base64.b64encode(halves).decode()
    assert secret_scan.scan(wrapped)[1] == [(0, len(wrapped), 0)]


@pytest.mark.parametrize("compress", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_content_behind_the_held_bytes_is_read(monkeypatch, compress):
    monkeypatch.setattr(secret_scan, "MOST_HELD", 1 << 16)
    monkeypatch.setattr(secret_scan, "CHUNK", 1 << 14)
    monkeypatch.setattr(secret_scan, "STEP", 1 << 12)
    nested = base64.b64encode(gzip.compress(b"AKIA" + b"A" * 16)).decode()
    long = "é, plain words. " * 20_000 + SECRET + ", " + "words, é " * 20_000 + nested
    wrapped = base64.b64encode(compress(gzip.compress(long.encode()))).decode()
    assert secret_scan.scan(f"x {wrapped}")[1] == [(2, 2 + len(wrapped), 0), (2, 2 + len(wrapped), 1)]
    # two bytes that aren't text don't hide what is; nothing is found in bytes without readable parts
    mixed = base64.b64encode(compress(long.encode() + b"\xff\xfe")).decode()
    assert secret_scan.scan(mixed)[1] == [(0, len(mixed), 0), (0, len(mixed), 1)]
    binary = base64.b64encode(compress(bytes(range(128, 256)) * 2000)).decode()
    assert secret_scan.scan(binary)[1] == []
    wide = base64.b64encode(compress(("words, " * 20_000 + SECRET).encode("utf-16-le"))).decode()
    assert [k for _, _, k in secret_scan.scan(wide)[1]] == [0]


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("width", [76, 64, 30])
@pytest.mark.parametrize("pack", [lambda x: x, gzip.compress, zstandard.compress])
def test_base64_over_line_breaks(pack, width, newline):
    noise = " ".join(f"w{k * 7919 % 1000}" for k in range(60))
    coded = base64.b64encode(pack(f"{noise}, {SECRET}, {noise[:31]}".encode())).decode()
    wrapped = newline.join(coded[k:k + width] for k in range(0, len(coded), width))
    _, every = secret_scan.scan(f"é 😀 {wrapped}\nwith more words")
    assert every == [(4, 4 + len(wrapped), 0)]
    assert secret_scan.masked(f"é 😀 {wrapped}\nwith more words", every) == "é 😀 [SECRET]\nwith more words"


def test_archives_that_unpack_to_each_other_end(monkeypatch):
    one, other = SECRET.encode(), SECRET.encode() + b"!"
    monkeypatch.setattr(secret_scan, "_unpacked", lambda raw: other if raw == one else one)
    wrapped = base64.b64encode(one).decode()
    assert secret_scan.scan(wrapped)[1] == [(0, len(wrapped), 0)]


def test_base_finds_by_the_plain_patterns(spark, documents, odd, empty):
    def plain(t):
        found = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        return [(a, b, k) for a, k, b in sorted(found)]

    tricky = ["password: token: abcdefgh", "token=secret=abcdef", "AKIAAKIA" + "A" * 12, "PASSWD = '123456'", "a" * 24, "ſecret=abcdefg", "%%% \\u \\x4 &#;" + "%4"]
    for t in [r.text or "" for r in documents.collect() + odd.collect()] + tricky:
        assert secret_scan.scan(t)[0] == plain(t)
    assert secret_scan.find_secrets(odd).count() == odd.count() and secret_scan.find_secrets(empty).count() == 0
    masked = secret_scan.mask_secrets(odd, n_chars="n_chars")
    assert masked.columns == odd.columns and masked.where("text like '%[SECRET]%'").first().n_chars == 26


def test_rule_counts(documents, odd, empty):
    for df in (documents, odd):
        rows = quality_rules.judge(df).collect()
        assert len(rows) == df.count()
        def counts(t):
            words = re.findall(r"[^\x20\x09-\x0D]+", t)
            grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
            seen = {g for g, c in Counter(grams).items() if c > 1}
            covered = {i + k for i, g in enumerate(grams) if g in seen for k in range(3)}
            lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)

        expected = sorted(counts(r.text or "") for r in df.collect())
        assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == expected
        assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in rows)
    assert quality_rules.judge(empty).count() == 0


def test_posterior_separates_junk(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.judge(docs).join(labels, "doc_id").where("not base_failed")
    assert rows.where("quality = 0 and kept").count() == 0 and rows.where("quality = 1 and not kept").count() == 0


def test_classifier_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.learn(docs, labels)
    rows = quality_classifier.score(docs, model).join(labels, "doc_id").where("held_out").select("quality", "predicted").collect()
    assert sum(r.quality == r.predicted for r in rows) >= 0.97 * len(rows) > 0
    assert 0.75 < model.prior < 0.95


def test_classifier_edge_cases(spark, odd, empty, documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (7, None)], "doc_id bigint, quality int")
    assert quality_classifier.learn(odd, labels) is None  # no trusted positive left
    rows = quality_classifier.score(odd, None).collect()
    assert {r.score for r in rows} == {0.5} and {r.predicted for r in rows} == {1} and len(rows) == odd.count()
    some = spark.createDataFrame([(5, 1), (6, 1), (8, 1)], "doc_id bigint, quality int")
    model = quality_classifier.learn(odd, some)
    assert all(0 <= r.score <= 1 for r in quality_classifier.score(odd, model).collect())
    assert quality_classifier.keep_good(odd, model).columns == odd.columns
    assert quality_classifier.score(empty, model).count() == 0 and quality_classifier.learn(empty, labels.where("false")) is None


HIDDEN = "password=hunter2secret"


def _archive():
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as archive:
        for name, data in (("blob", bytes(range(256)) * 3), ("app.env", HIDDEN.encode())):
            member = tarfile.TarInfo(name)
            member.size = len(data)
            archive.addfile(member, io.BytesIO(data))
    return out.getvalue()


@pytest.mark.parametrize("run", [
    base64.urlsafe_b64encode(("~~~???>>>" + HIDDEN + " ~~~???").encode()).decode(),
    base64.urlsafe_b64encode(("twenty plain signs before it " + HIDDEN + "\u00ff\u00bf\u00ff").encode()).decode(),
    base64.b64encode(HIDDEN.encode("utf-16-le")).decode(),
    base64.b64encode(("a " + HIDDEN).encode("utf-16-be")).decode(),
    base64.b64encode(("contrase\u00f1a \u00e9 \u00fc " + HIDDEN).encode("latin-1")).decode(),
    base64.b64encode(b"\x00\x01\xff\xfe" * 40 + HIDDEN.encode() + b"\xff\x80").decode(),
    base64.b64encode(_archive()).decode(),
])
def test_secrets_in_other_encodings_and_archives(run):
    text = f"see '{run}' there"
    assert ("assign" in secret_scan.written(secret_scan.scan(text)[1])) and (5, 5 + len(run), 0) in secret_scan.scan(text)[1]


def test_plain_run_behind_a_dash():
    run = base64.b64encode(b"it is " + HIDDEN.encode()).decode()
    assert (3, 3 + len(run), 0) in secret_scan.scan(f"ab-{run}")[1]


@pytest.mark.parametrize("front, level, last", [("%", "25", "70"), ("\\", "u005c", "u0070"), ("&", "amp;", "#x70;")])
def test_deeply_nested_escapes_take_linear_time(front, level, last):
    for depth in (1, 2, 3, 20_000):
        text = "x " + front + level * depth + last + "assword=hunter2secret"
        start = time.perf_counter()
        assert (2, len(text), 0) in secret_scan.scan(text)[1]
        assert time.perf_counter() - start < 2


def test_unmatched_end_tags_take_linear_time():
    start = time.perf_counter()
    assert html_text.main_text("<div>" * 16_000 + "A text." + "</section>" * 16_000 + "</div>" * 16_000) == "A text."
    assert time.perf_counter() - start < 3


def test_estimate_equals_brute_force(spark):
    """The steps over vote patterns, row by row in plain Python, to the same end."""
    rules = ["vote_a", "vote_b", "vote_c"]
    table = [(-1, -1, 0, 40), (1, 0, 1, 300), (1, 1, 1, 200), (0, -1, -1, 25), (0, 0, 0, 60), (1, -1, 1, 9)]
    patterns = spark.createDataFrame(table, "vote_a int, vote_b int, vote_c int, n bigint")
    start = quality_rules.Estimate(rules)
    good, shares = start.good, {r: {y: dict(start.shares[r][y]) for y in (0, 1)} for r in rules}

    def posterior(votes):
        p = [1 - good, good]
        for y in (0, 1):
            for r, v in zip(rules, votes):
                p[y] *= shares[r][y][v]
        return p[1] / sum(p)

    for _ in range(300):
        ps = [posterior(row[:3]) for row in table]
        weight = [sum(row[3] * (1 - p) for row, p in zip(table, ps)), sum(row[3] * p for row, p in zip(table, ps))]
        new = {r: {y: {v: (sum(row[3] * (p if y else 1 - p) for row, p in zip(table, ps) if row[k] == v) + 10 * start.shares[r][y][v]) / (weight[y] + 10) for v in (-1, 0, 1)} for y in (0, 1)} for k, r in enumerate(rules)}
        new_good = (weight[1] + 10 * start.good) / (sum(weight) + 10)
        moved = max(abs(new_good - good), *(abs(new[r][y][v] - shares[r][y][v]) for r in rules for y in (0, 1) for v in (-1, 0, 1)))
        good, shares = new_good, new
        if moved < 1e-6:
            break
    found = quality_rules.estimate(patterns, rules)
    assert found.good == pytest.approx(good, abs=1e-9)
    assert all(found.shares[r][y][v] == pytest.approx(shares[r][y][v], abs=1e-9) for r in rules for y in (0, 1) for v in (-1, 0, 1))
    got = {(r.vote_a, r.vote_b, r.vote_c): r.p for r in patterns.withColumn("p", found.posterior()).collect()}
    assert all(got[row[:3]] == pytest.approx(posterior(row[:3]), abs=1e-9) for row in table)
    with pytest.warns(UserWarning, match="still moves"):
        quality_rules.estimate(patterns, rules, steps=2)
    assert math.isfinite(quality_rules.estimate(patterns.where("false"), rules).good)


def test_marked_words_of_a_sentence_stay():
    page = "<article><p>An <em class='notice'>important remark</em> here, and <b id=\"related\">one more</b>.<span class='share'>Share</span></p><p>A second line.</p></article>"
    assert html_text.main_text(page) == "An important remark here, and one more.\nA second line."
    assert html_text.main_text("<article><p>Seen <i hidden>not this</i> and this.</p></article>") == "Seen and this."
