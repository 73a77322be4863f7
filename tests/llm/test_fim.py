"""Fill-in-middle: the registered query against plain slices, ropes against strings, odd rows and columns."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from foliomill.llm import fim, queries


def plain_form(doc_id, text):
    """n, form, prefix and middle lengths, output by string slices."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


ODD = [None, "", " ", "a", "<P>", "x <S> y", "ends with <", "<M", ">P<", "𝒳é́\U0001f937‍♂️" * 50, "long words " * 30000, "\n\n", "<<P> <M>"]


def test_query_against_slices(spark, tmp_path):
    rnd = random.Random(3)
    texts = ODD + ["".join(rnd.choice("ab <PSM>é𝒳\n") for _ in range(rnd.randint(0, 40))) for _ in range(200)] + ["same"] * 3
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(5, "again", "s"), (5, "again", "s"), (None, "no key", None), (-7, "below", None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op11_fill_in_middle(spark, str(tmp_path)).collect()), key=str)
    want = []
    for i, t, _ in rows:
        *facts, out = plain_form(i, t)
        want.append((i, *facts, sha(out), sha(t or "")))
    assert got == sorted(want, key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_ropes_split_and_join_as_strings_do():
    rnd = random.Random(5)
    for _ in range(60):
        text = "".join(rnd.choice("ab \né𝒳") for _ in range(rnd.randint(0, 9000)))
        rope = fim.grow(text)
        assert fim.written(rope) == text and (rope.units if rope else 0) == len(text)
        parts = []
        for _ in range(8):
            at = rnd.randint(0, rope.units if rope else 0)
            head, rope = fim.split(rope, at)
            parts.append(fim.written(head))
            assert (head.chars if head else 0) == at
        assert "".join(parts) + fim.written(rope) == text


def test_ropes_stay_low():
    rope = None
    for i in range(3000):
        rope = fim.join(rope, fim.leaf(str(i % 10)))
    assert rope.units == 3000 and rope.height <= 18
    left, right = fim.split(rope, 1234)
    assert (left.units, right.units) == (1234, 1766) and max(left.height, right.height) <= 20


def test_units_by_pattern(spark):
    text = "one  two three\nfour, " * 900
    docs = spark.createDataFrame([(i, text[i:]) for i in range(40)], "k long, t string")
    made = fim.restore(fim.fill_in_middle(docs, key="k", text="t", unit=r"\S+\s*")).collect()
    for r in made:
        want = text[r.k :]
        assert r.restored == want
        assert r.n == len(want.split()) + want[:1].isspace()
        if r.form != "plain":
            starts = {0, len(want), *[i for i in range(1, len(want)) if want[i - 1].isspace() and not want[i].isspace()]}
            assert r.prefix_chars in starts and r.prefix_chars + r.middle_chars in starts


def test_sentinels_that_could_be_found_elsewhere(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for bad in (("", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("ab", "abc", "x"), ("aba", "c", "d"), ("xa", "ay", "z")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(docs, marks=fim.Marks(*bad))


def test_malformed_outputs_restore_to_null(spark):
    made = spark.createDataFrame([("<P>a<S>b", "psm"), ("a", "spm"), (None, "psm"), ("a", None), ("a", "plain"), ("<S>b<P>a<M>c", "spm")], "output string, form string")
    assert [r.restored for r in fim.restore(made).collect()] == [None, None, None, None, "a", "acb"]


def test_odd_columns_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "some text here", 3, 4, 5, 6)], "doc_id long, text string, `a.b` int, `c``d` int, _row int, Form int")
    made = fim.fill_in_middle(docs)
    assert made.columns == ["doc_id", "a.b", "c`d", "_row", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = fim.restore(made).first()
    assert back["restored"] == "some text here" and back["a.b"] == 3 and back["c`d"] == 4 and back["_row"] == 5
    none = fim.restore(fim.fill_in_middle(docs.where(F.lit(False))))
    assert none.count() == 0 and none.columns[-1] == "restored"
