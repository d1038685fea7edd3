import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from chorale.llm import fill_middle as fm

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, n, "plain", None, None, text, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return (doc_id, n, form, len(p), len(m), out, text)


def result(df):
    rows = fm.with_restored(fm.fill_in_middle(df)).collect()
    return sorted(
        ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in rows), key=repr)


def test_matches_brute_force(documents, odd_rows):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(
        ["a", " lead and trail \n", "<P> sentinel", "x <M", "<S", "é ü \U0001f600 z", "one two three four", "\n\n", "<P", "S> x <"] * 12)]
    rows += [(500 + i, "long text with words " * 30_000) for i in range(6)]
    assert result(documents(rows)) == sorted((brute(*r) for r in rows), key=repr)
    assert result(documents([])) == []


def test_all_forms_occur_and_other_columns_stay(documents):
    rows = [(i, f"w{i} x y z") for i in range(200)]
    df = documents(rows, extra=("e", "f")).withColumnsRenamed({"x0": "form", "x1": "_text"})
    out = fm.fill_in_middle(df).collect()
    assert {r.form for r in out} == {"plain", "psm", "spm"} and {r["_text"] for r in out} == {"f"}
    assert {r.text for r in out} == {t for _, t in rows}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab <>PSM\né", max_size=30), st.data())
def test_rotations_invert(text, data):
    body = text.encode()
    ends = [0, *fm.unit_ends(body).tolist()]
    assert len(ends) - 1 == len(UNIT.findall(text))
    a, b = sorted((data.draw(st.sampled_from(ends)), data.draw(st.sampled_from(ends))))
    if any(m in body for m in (fm.PREFIX, fm.SUFFIX, fm.MIDDLE)):
        return
    p, m, s = body[:a], body[a:b], body[b:]
    psm, spm = fm.rearranged(body, a, b, "psm"), fm.rearranged(body, a, b, "spm")
    assert psm == b"<P>" + p + b"<S>" + s + b"<M>" + m and spm == b"<S>" + s + b"<P>" + p + b"<M>" + m
    assert fm.restored(psm, "psm") == fm.restored(spm, "spm") == body
