import random

import pytest
from helpers import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from chronolode.llm import lines


def within_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows, least):
    """(doc_id, line_no, seen doc, seen line) of every removed line, each compared with all earlier ones."""
    far = 1 << 63
    all_lines = [(far if d is None else d, n, x) for d, t in rows for n, x in enumerate((t or "").split("\n")) if len(x) >= least or x.strip()]
    out = set()
    for d, n, x in all_lines:
        seen = min((e, m) for e, m, y in all_lines if x == y or min(len(x), len(y)) >= least and within_one(x, y))
        if seen < (d, n):
            out.add((None if d == far else d, n, *(None if v == far else v for v in seen)))
    return out


def found(df):
    return {(r.doc_id, r.line_no, r.seen_doc_id, r.seen_line_no) for r in df.collect()}


@settings(max_examples=200, deadline=None)
@given(st.text("ab\U0001f600", max_size=9), st.text("ab\U0001f600", max_size=9))
def test_variants_in_common(a, b):
    x, y = (set(zip(*(k.tolist() for k in lines.variant_keys(t)))) for t in (a, b))
    if within_one(a, b):
        assert x & y
    cut = lambda t: {t, *(t[:i] + t[i + 1 :] for i in range(len(t)))}
    assert len(x | y) == len(cut(a) | cut(b))


def random_rows(rng, n):
    rows = []
    for i in range(n):
        text = "\n".join("".join(rng.choice("aabé") for _ in range(rng.randrange(3, 12))) for _ in range(rng.randrange(5)))
        rows.append((rng.choice([i, i, i, None]), text))
    return rows


def test_by_brute_force(spark):
    base = "the quick brown fox jumps over it"
    rows = [(1, base), (2, base[:-1]), (3, base + "!"), (4, "x" + base), (5, base.replace("q", "Q")), (6, base.replace("quick", "slow"))]
    rows += [(7, None), (8, ""), (9, "\n\n"), (10, f"short\n{base}\nshort\n{base}"), (11, "z" * 20_000), (12, "z" * 19_999 + "y"), (13, "z" * 10_000 + "zz" + "z" * 9_999)]
    df = documents(spark, rows, extra=True)
    assert found(lines.removed_lines(df)) == brute(rows, lines.MIN_CHARS)


@pytest.mark.parametrize("seed", range(3))
def test_many_alike(spark, seed):
    rows = [(100 + i, t) for i, (_, t) in enumerate(random_rows(random.Random(seed), 120))]
    assert found(lines.removed_lines(documents(spark, rows), 3)) == brute(rows, 3)


def test_chain_and_copies(spark):
    rows = [(i, "a" * 20 + "b" * min(i, 5)) for i in range(12)] + [(None, "a" * 20)]
    out = found(lines.removed_lines(documents(spark, rows)))
    assert out == brute(rows, lines.MIN_CHARS) and (2, 0, 1, 0) in out and (None, 0, 0, 0) in out


def test_dropping(spark):
    keep, copy = "a line that stays for good", "another line that everyone has"
    rows = [(1, f"{copy}\n{keep}"), (2, copy), (3, f"short\n{copy}\nnew words of the third one"), (4, None), (5, ""), (None, copy)]
    docs = documents(spark, rows, extra=True)
    left = lines.drop_repeated_lines(docs)
    assert left.columns == docs.columns
    got = {(r.doc_id, r.text, r.n_chars, r.line) for r in left.collect()}
    assert got == {(1, rows[0][1], len(rows[0][1]), "y"), (3, "short\nnew words of the third one", 32, "y"), (4, None, None, "y"), (5, "", 0, "y")}


def test_none(spark):
    assert lines.removed_lines(documents(spark, [])).collect() == []
    assert lines.drop_repeated_lines(documents(spark, [])).collect() == []


def test_rows_without_ids_stay_apart(spark):
    """Lines of several rows without doc_id, at the same place: only those with an earlier partner go."""
    base = "the quick brown fox jumps"
    rows = [(None, f"{base}\nsomething else entirely"), (None, f"words that nobody else has\n{base}"), (None, "yet another text here"), (4, "what the fourth one says"), (4, base + "!")]
    got = sorted((str(r.doc_id), r.line_no, str(r.seen_doc_id)) for r in lines.removed_lines(documents(spark, rows)).collect())
    assert got == [("None", 0, "4"), ("None", 1, "4")]


def test_dropping_by_row(spark):
    """Rows without doc_id, or with one in common, lose their own repeated lines and no others; equal rows leave one."""
    copy, twice = "a line that everyone has", "words of rows that are equal"
    rows = [(1, copy), (None, f"{copy}\nwhat only A has to say"), (None, "nobody but B says such things\nand here is more of it"), (None, f"something new from C\n{copy}")]
    rows += [(5, f"{copy}\nfirst of the fives has this"), (5, "the second of them has that\nand a second line of its own")]
    rows += [(None, twice)] * 3 + [(7, f"seven says it two times\n{twice} again")] * 2 + [(None, None), (None, None), (None, ""), (None, "tiny"), (None, "tiny")]
    docs = documents(spark, rows, extra=True)
    got = sorted((str(r.doc_id), str(r.text)) for r in lines.drop_repeated_lines(docs).collect())
    want = [(1, copy), (None, "what only A has to say"), (None, rows[2][1]), (None, "something new from C"), (5, "first of the fives has this"), rows[5]]
    want += [(None, twice), rows[9], (None, None), (None, None), (None, ""), (None, "tiny")]
    assert got == sorted((str(d), str(t)) for d, t in want)
    listed = sorted((str(r.doc_id), r.line_no, str(r.seen_doc_id)) for r in lines.removed_lines(docs).collect())
    assert listed == sorted([("None", 0, "1"), ("None", 1, "1"), ("5", 0, "1"), ("None", 0, "None"), ("None", 0, "None"), ("None", 0, "None"), ("7", 0, "7"), ("7", 1, "7")])


def test_short_lines(spark):
    """Equal short lines go, also those of one letter; similar ones and blank ones stay."""
    rows = [(1, "Share\n \n\nx\nSharf"), (2, "Share\n \n\nshare\nx"), (3, "x\nShare"), (4, "a line of its own\n\t\nx")]
    docs = documents(spark, rows)
    assert found(lines.removed_lines(docs)) == brute(rows, lines.MIN_CHARS) == {(2, 0, 1, 0), (2, 4, 1, 3), (3, 0, 1, 3), (3, 1, 1, 0), (4, 2, 1, 3)}
    left = {r.doc_id: r.text for r in lines.drop_repeated_lines(docs).collect()}
    assert left == {1: rows[0][1], 2: " \n\nshare", 4: "a line of its own\n\t"}
