import hashlib
import re

from hypothesis import given, settings, strategies as st

from roomtide.llm import fill_middle as fim


def brute(doc_id, text, seed=7, percent=100, spm_percent=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= percent:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_percent:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.integers(), st.lists(st.sampled_from(["\n", "\n\n\n", "a", "é😀", "<P", ">", "<S>", "<", "word ", "\r"]), max_size=40).map("".join))
def test_equals_brute_force(doc_id, text):
    for options in ({}, {"percent": 30, "spm_percent": 0}, {"seed": 3, "spm_percent": 100}):
        got = fim.transformed(doc_id, text, **options)
        assert got == brute(doc_id, text, **options)
        assert fim.restored(got[-1], got[1]) == text


def test_every_kind_of_container_selects_every_end():
    text = "\n" * 70_000 + "a\n" * 70_000 + "é" * 200_000 + "\nlast"
    ends = fim.Boundaries(text)
    assert {type(c) for c in ends.containers} == {fim.RunContainer, fim.BitmapContainer, fim.ArrayContainer}
    found = [m.end() for m in re.finditer(r"[^\n]*\n|[^\n]+", text)]
    assert len(ends) == len(found) and ends.end(0) == 0
    assert [ends.end(k) for k in range(1, len(found) + 1, 17)] == found[::17] and ends.end(len(found)) == len(text)


def test_a_mark_may_only_come_about_at_a_cut():
    for text in ("<\nP>x\n<S\n>", "<<\n<\n>P>", "<M\nM>\n"):
        for doc_id in range(30):
            _, form, _, _, output = fim.transformed(doc_id, text)
            assert form != "plain" and fim.restored(output, form) == text


def test_query_on_odd_rows(odd, empty):
    rows = fim.digests(odd).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = [(r.doc_id, *brute(r.doc_id, r.text or "")[:4], sha(brute(r.doc_id, r.text or "")[4]), sha(r.text or "")) for r in odd.collect()]
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    assert fim.digests(empty).count() == 0 and fim.digests(empty).columns == fim.digests(odd).columns


def test_texts_out_and_back(odd):
    clash = odd.withColumnRenamed("ids", "Output").withColumnRenamed("kept", "form")
    out = fim.transform(clash)
    assert [c for c in out.columns if c.lower() in ("output", "form")] == ["form", "output"]
    rows = fim.restore(out).collect()
    assert len(rows) == odd.count() and all(r.restored == (r.text or "") for r in rows)
    assert [r.restored for r in fim.restore(out.selectExpr("cast(null as string) as output", "form")).collect()] == [None] * odd.count()
