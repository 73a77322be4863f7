"""Verdicts from evidence against plain Python: exact excerpts, other passages, near ones by edit distance."""

import random

from pyspark.sql import functions as F

from foliomill.operators import qa


def least_edits(excerpt, text):
    """Edits between the excerpt and its nearest stretch of the text, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(excerpt):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(row[j] + (c != x), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_edits_against_the_whole_table():
    rnd = random.Random(7)
    tried = 0
    for _ in range(150):
        text = "".join(rnd.choice("abcdé𝒳医") for _ in range(rnd.randint(0, 150)))
        at = rnd.randint(0, max(0, len(text) - 40))
        part = list(text[at : at + 40])
        for _ in range(rnd.randint(0, 6)):
            if part:
                i = rnd.randrange(len(part))
                part[i : i + rnd.choice([0, 1])] = rnd.choice(["", "a", "zz"])
        excerpt = "".join(part)
        limit = len(excerpt) // 5
        seeds = {text[i : i + min(qa.KEY, len(excerpt))] for i in range(len(text))}
        shares = any(excerpt[i : i + qa.KEY] in seeds for i in range(max(1, len(excerpt) - qa.KEY + 1)))
        got, want = qa.edits(excerpt, text, limit), least_edits(excerpt, text)
        if not excerpt or not shares or want > limit:
            assert got is None
        else:
            tried += 1
            assert got == want
    assert tried > 60


def test_verdicts(spark):
    body = {("a", "第一条"): "医疗器械注册人应当加强医疗器械全生命周期质量管理，对研制、生产、经营、使用全过程负责。", ("a", "第二条"): "国家鼓励医疗器械的研究与创新，将医疗器械创新纳入发展重点。", ("b", "第一条"): "从事医疗器械生产活动，应当具备与生产的医疗器械相适应的生产场地、环境条件、生产设备。", ("b", "第二条"): None}
    passages = spark.createDataFrame([(p, a, t) for (p, a), t in body.items()], "path string, article string, text string")
    one, two, three = (body[k] for k in (("a", "第一条"), ("a", "第二条"), ("b", "第一条")))
    cases = [
        ("a", "第一条", one[3:30], "正确", "a", "第一条", 0),
        ("a", "第一条", one[:12] + "……" + one[-9:], "正确", "a", "第一条", 0),
        ("a", None, two[2:20], "正确", "a", "第二条", 0),
        ("a", "第二条", one[3:30], "条次误用", "a", "第一条", 0),
        ("c", "第一条", three[:20], "条次误用", "b", "第一条", 0),
        (None, None, three[:20], "条次误用", "b", "第一条", 0),
        ("a", "第一条", one[:20] + "不" + one[20:40], "摘抄错误", "a", "第一条", 1),
        ("b", "第一条", three[:14] + three[16:36], "摘抄错误", "b", "第一条", 2),
        ("a", "第一条", "企业法定代表人须每年向县级部门提交书面年报并公示三十日", "编造", None, None, None),
        ("a", "第一条", "", "溯源不足", None, None, None),
        ("a", "第一条", None, "溯源不足", None, None, None),
        ("a", "第一条", "……", "溯源不足", None, None, None),
    ]
    rows = [(i // 3, i, p, a, e) for i, (p, a, e, *_) in enumerate(cases)] + [(9, 99, *cases[3][:3])]
    got = sorted((tuple(r) for r in qa.verdicts(spark.createDataFrame(rows, "answer_id int, seq int, path string, article string, excerpt string"), passages).collect()), key=lambda r: r[1])
    assert got == [(i // 3, i, *c[3:]) for i, c in enumerate(cases)] + [(9, 99, *cases[3][3:])]
    empty = qa.verdicts(spark.createDataFrame(rows[:2], "answer_id int, seq int, path string, article string, excerpt string"), passages.where("path = 'none'"))
    assert [r.verdict for r in empty.collect()] == ["编造", "编造"]


def test_edits_of_many_pairs_side_by_side():
    rnd = random.Random(11)
    excerpts, texts = [], []
    for _ in range(120):
        text = "".join(rnd.choice("abcdefgh é𝒳医") for _ in range(rnd.randint(20, 160)))
        at, n = rnd.randint(0, len(text) - 15), rnd.randint(13, 60)
        part = list(text[at : at + n])
        if len(part) > 13:
            part[13:13] = rnd.choice(["", "z", "zz"])
        excerpts.append("".join(part))
        texts.append(rnd.choice([text, text, texts[-1] if texts else text]))
    excerpts, texts = [*excerpts, "", "abc"], [*texts, "abc", ""]
    limits = [len(x) // 5 for x in excerpts]
    want = [least_edits(x, t) if any(x[i : i + qa.KEY] in t for i in range(max(1, len(x) - qa.KEY + 1))) and x else None for x, t in zip(excerpts, texts, strict=True)]
    want = [w if w is not None and w <= limit else None for w, limit in zip(want, limits, strict=True)]
    assert qa.all_edits(excerpts, texts, limits) == want and sum(w is not None for w in want) > 60


def test_texts_are_read_once_for_a_million_keys(spark, tmp_path):
    folder = str(tmp_path)

    @F.udf("string")
    def read(path):
        with open(f"{folder}/{path}", "a") as f:
            f.write("x")
        return "the quick brown fox " * 3 + path

    bodies = spark.range(6).select(F.col("id").cast("string").alias("path")).withColumn("text", read.asNondeterministic()("path"))
    wanted = [int(x) for x in qa._windows("quick brown fox", 12).view("int64")]
    keys = spark.range(1 << 20).select(F.lit(12).alias("n"), F.xxhash64("id").alias("h")).unionByName(spark.createDataFrame([(12, h) for h in wanted], "n int, h long"))
    found = qa._looked_up(keys, bodies).join(keys.distinct(), ["n", "h"]).select("path", "h").collect()
    assert sorted((r.path, r.h) for r in found) == sorted((str(p), h) for p in range(6) for h in wanted)
    assert [len(f.read_text()) for f in tmp_path.iterdir()] == [1] * 6
