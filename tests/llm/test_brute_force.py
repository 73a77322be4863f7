"""Operators, their queries and the pipeline's stages held against plain Python."""

import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from test_llm import BYTE, WORD, brute_set, repeats_removed
from tokenizers import Tokenizer

import corpus_pipeline
from foliomill.llm import language_id, media, packing, quality, queries
from foliomill.session import shared_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PARTS = {"en": ("the", "ing", "wh", "and"), "de": ("sch", "ung", "ä", "ein"), "fr": ("eau", "oi", "é", "que")}


def sentence(rnd, lang, n=10):
    return " ".join("".join(rnd.choice(PARTS[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n)) + ". "


@pytest.fixture(scope="module")
def corpus():
    """Documents with junk, unknown languages, copies, near copies, shared passages, odd rows; and labels."""
    rnd = random.Random(11)
    texts = [("".join(sentence(rnd, lang) for _ in range(rnd.randint(6, 12))), lang) for lang in PARTS for _ in range(12)]
    junk = [(" ".join(rnd.choice(["BUY!!", "$$$", "###", "<<x>>", "|A|"]) for _ in range(80)), "en") for _ in range(12)]
    passage = "".join(sentence(rnd, "en") for _ in range(7))
    shared = [(sentence(rnd, "en", 25) + passage + sentence(rnd, "en", 25 + i), "en") for i in range(3)]
    near = [(t.replace(t.split()[7], "ingwhand", 1), lang) for t, lang in texts[:6]]
    odd = [(None, "en"), ("", None), (" \n", "de"), ("12 34 " * 30, None), (texts[3][0], "en"), ("the ing and " * 9000, "en"), ("wh the. ing the. and wh. " * 2, "en")]
    rows = [(i, t, lang, "s", len(t or "")) for i, (t, lang) in enumerate(texts + junk + shared + near + odd)]
    rows += [rows[5], (7, *rows[8][1:]), (None, *rows[9][1:]), (None, None, None, None, None)]
    labels = [(i, int(not (t or "").isupper() and i not in range(36, 48)), 0) for i, t, *_ in rows[:60] if i % 4] + [(None, 1, 0), (2, None, 0), (1, 1, 0)]
    return rows, labels


@pytest.fixture(scope="module")
def sf_dir(spark, corpus, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    rows, labels = corpus
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    vectors = [(i, [float(x) for x in np.random.default_rng(i).normal(size=8)]) for i in range(120)] + [(50, [0.1] * 8), (7, None), (None, [1.0] * 8), (9, [float("nan")] * 8), (300, [1.0, 2.0])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<double>").write.parquet(f"{d}/embeddings.parquet")
    return d


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def exact_language(rows, learned, text):
    """The language and score by exact sets of trigrams."""
    counts = {}
    for _, t, lang, *_ in rows:
        if lang is not None and learned:
            counts.setdefault(lang, Counter()).update(language_id.trigrams(t).tolist())
    rates = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    rates = {lang: {g: r for g, r in c.items() if r >= 1e-5} for lang, c in rates.items()}
    most = Counter()
    for c in rates.values():
        for g, r in c.items():
            most[g] = max(most[g], r)
    sets = {lang: {g for g, r in c.items() if r >= 0.2 * most[g]} for lang, c in rates.items()}
    grams = language_id.trigrams(text).tolist()
    if not grams:
        return "und", 0.0
    hits = {lang: sum(g in s for g in grams) / len(grams) for lang, s in sets.items()}
    best = max(sorted(hits), key=hits.get)
    return best, hits[best]


def test_language_query_is_near_exact_sets(spark, corpus, sf_dir):
    rows, _ = corpus
    learn = [r for r in rows if r[0] is not None and crc(r[0], 4) != 2]
    want = sorted((str(r[0]), r[0] is not None and crc(r[0], 4) == 2, *exact_language(learn, True, r[1])) for r in rows)
    got = sorted((str(r.doc_id), r.held_out, r.lang_pred, r.score) for r in queries.op3_language_id(spark, sf_dir).collect())
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:2] == w[:2] and (g[2] == w[2] or w[3] < 0.2) and abs(g[3] - w[3]) < 0.05


def test_sharding_query_by_its_rule(spark, corpus, sf_dir):
    def cost(key, shard):
        h = xxhash.xxh64(struct.pack("<i", shard), seed=xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest() if key is not None else 42).intdigest()
        return -math.log(((h >> 12) + 0.5) / 2**52)

    rows, _ = corpus
    got = queries.op8_sharding(spark, sf_dir).collect()
    facts = Counter()
    for i, t, *_ in rows:
        raw = (t or "").encode()
        shard, grown = (min(range(n), key=lambda s: cost(i, s)) for n in (24, 25))
        facts[i, len(raw) + 8, zlib.crc32(raw), "key", shard, grown] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == facts
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def plain_features(text):
    """The features of a text, by loops."""
    data = (text or "").encode()
    groups = ["\n\r", " \t\v\f", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",;:", "!?", "\"'()", "#$%&*@", "|/\\", "-_", "<>{}[]=+~^`"]
    kind = lambda b: 13 if b >= 0xC0 else 14 if b >= 0x80 else next((i for i, g in enumerate(groups) if chr(b) in g), 15)
    pairs = Counter((kind(a), kind(b)) for a, b in zip(data, data[1:], strict=False))
    if not data:
        return [0.0] * 263
    words, lines = text.split(), text.split("\n")
    n = len(words)
    shares = [math.sqrt(pairs[a, b] / max(1, len(data) - 1)) for a in range(16) for b in range(16)]
    return shares + [math.log1p(len(data)), math.log1p(n), math.log1p(len(set(words))), len(set(words)) / max(1, n), len(set(lines)) / len(lines), len(text) / max(1, n) / 10, math.log1p(len(lines))]


def test_quality_features_and_pairwise_loss(corpus):
    rows, _ = corpus
    texts = [r[1] for r in rows if len(r[1] or "") < 5000]
    assert np.allclose(quality.features(texts), [plain_features(t) for t in texts], atol=1e-5)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 4))
    y = (x[:, 0] + 0.5 * rng.normal(size=60) > 0).astype(int)
    w = quality.fit_pairs(x, y, pairs=500)
    again = np.random.default_rng(7)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    a, b = again.choice(good, 500), again.choice(bad, 500)

    def loss(w):
        return sum(math.log1p(math.exp(-sum((x[i][k] - x[j][k]) * w[k] for k in range(4)))) for i, j in zip(a, b, strict=True)) / 500 + 5e-4 * sum(v * v for v in w)

    least = loss(w)
    assert all(loss([v + s * (k == i) for k, v in enumerate(w)]) > least for i in range(4) for s in (0.05, -0.05))


def test_quality_query_by_hand(spark, corpus, sf_dir):
    rows, labels = corpus
    model = quality.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"), learn=queries.crc_mod(5) != 0)
    got = sorted((str(r.doc_id), r.held_out, r.score, r.predicted) for r in queries.op9_quality_classifier(spark, sf_dir).collect())
    want = []
    for i, t, *_ in rows:
        raw = float((np.array(plain_features(t)) - model["mean"]) / model["std"] @ model["w"])
        s = 1 / (1 + math.exp(-(math.log(0.3 / 0.7) + model["scale"] * (raw - model["at"]))))
        want.append((str(i), i is not None and crc(i, 5) == 0, s, raw))
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:2] == w[:2] and abs(g[2] - w[2]) < 1e-3 and g[3] == (g[2] >= 0.3) and (abs(w[3] - model["at"]) < 1e-3 or g[3] == (w[3] >= model["at"]))
    junk = {str(i) for i in range(36, 48)}
    assert all(p == 0 for i, _, _, p in got if i in junk) and sum(p for i, _, _, p in got if i.isdigit() and int(i) < 36) >= 34
    # repeated keys on both sides leave the sample bounded
    double = spark.createDataFrame(rows + rows, DOCS)
    assert quality.fit(double, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), learn=F.lit(True), most=10)["prior"] is None


def test_token_query(spark, corpus, sf_dir):
    rows, _ = corpus
    t = Tokenizer.from_file(WORD)
    got = queries.op4_token_planes(spark, sf_dir).collect()
    coded = {r[:2]: np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for r in rows}
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((r[0], len(coded[r[:2]]) // 4, zlib.crc32(coded[r[:2]])) for r in rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    again = queries.op4_token_planes(spark, sf_dir).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))  # equal ids keep their places


def test_media_query(spark, corpus, sf_dir):
    rows, _ = corpus
    got = sorted((str(r.doc_id), r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in queries.op5_media_columns(spark, sf_dir).collect())
    want = []
    for i, t, *_ in rows:
        raw = (t or "").encode()
        full = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        want.append((str(i), len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:])))
    assert got == sorted(want)


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def container(**tables):
    """A track with the given sample tables, written by hand."""
    u = lambda *n: struct.pack(f">{len(n)}I", *n)
    made = {"stsz": u(0, 0, 3, 5, 6, 7), "stsc": u(0, 1, 1, 2, 1), "stco": u(0, 2, 8, 40), "stss": u(0, 2, 1, 3)} | tables
    stbl = box(b"stbl", *[box(k.encode(), v) for k, v in made.items() if v is not None])
    mdhd = box(b"mdhd", u(1 << 24), struct.pack(">QQIQ", 0, 0, 90000, 777))
    moov = box(b"moov", box(b"trak", box(b"mdia", mdhd, box(b"minf", stbl))))
    return box(b"mdat", bytes(range(60))) + moov


def test_media_of_other_writers_and_malformed_ones(spark):
    u = lambda *n: struct.pack(f">{len(n)}I", *n)
    deep = b""
    for _ in range(5000):
        deep = box(b"moov", deep)
    cases = {
        "good": container(), "large sync": container(stss=u(0, 1, 9)), "sync 0": container(stss=u(0, 2, 0, 1)), "sync order": container(stss=u(0, 2, 3, 1)),
        "many equal": container(stsz=u(0, 1, 4_000_000_000)), "huge table": container(stsz=u(0, 0, 4_000_000_000)), "outside": container(stco=u(0, 2, 8, 4_000_000)),
        "no chunks": container(stco=u(0, 0)), "run 0": container(stsc=u(0, 1, 0, 2, 1)), "huge run": container(stsc=u(0, 1, 1, 4_000_000_000, 1)), "no map": container(stsc=None),
        "overlap": container(stsz=u(0, 50, 3), stco=u(0, 3, 8, 8, 8), stsc=u(0, 1, 1, 1, 1)), "deep": deep, "short": b"\0\0\0", "box": b"\0\0\xff\xffmoov", "empty": b"", "none": None,
        "offset": container(stco=None, co64=u(0, 2) + struct.pack(">QQ", 1 << 63, 8)),
    }
    df = spark.createDataFrame([(k, bytearray(v) if v is not None else None) for k, v in cases.items()], "name string, media binary")
    got = {r.name: r for r in media.read_media(df).collect()}
    good = got["good"]
    data = cases["good"]
    assert (good.status, good.n_samples, good.duration, good.timescale) == ("ok", 3, 777, 90000)
    assert bytes(good.payload) == data[8:19] + data[40:47] and [(k.offset, k.size) for k in good.keyframes] == [(8, 5), (40, 7)]
    fine = {"good", "huge run", "overlap"}  # a run may hold more samples than there are; what samples share is bounded by the file
    assert got["none"].status == "null" and got["empty"].status == got["short"].status == "no track"
    assert all(got[k].status.startswith("malformed") and got[k].payload is None for k in cases if k not in fine | {"none", "empty", "short"})


def test_topk_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(map(math.isfinite, v))]
    want = []
    for q in sorted({i for i, _ in whole if i % 50 == 0}):
        asked = min(v for i, v in whole if i == q)
        scored = sorted((-sum(a * b for a, b in zip(asked, v, strict=True)), i) for i, v in whole if i != q and len(v) == len(asked))
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    assert sorted(tuple(r) for r in queries.op6_exact_topk(spark, sf_dir).collect()) == sorted(want)


def test_packing_of_a_few_huge_documents(spark):
    """Ten documents of some 60,000 ids: groups go by bytes, and padding stays small."""
    rnd = random.Random(1)
    data = [(i, " ".join(rnd.choice(["the", "of", "and", "in"]) for _ in range(60_000 + i))) for i in range(10)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(2)
    got = packing.pack_documents(df, WORD, 2, window=512, group_bytes=1 << 18).select("doc_id", "start", "length", "sequence_id", "offset").collect()
    groups = Counter(r.sequence_id >> 32 for r in got)
    assert len(groups) > 5 and max(groups.values()) < 3 * len(got) / len(groups)
    used = {r.sequence_id: 0 for r in got}
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 512 and sum(used.values()) == sum(60_001 + i for i in range(10)) and sum(used.values()) / (512 * len(used)) > 0.97


def test_bpe_query(spark, corpus, sf_dir):
    rows, _ = corpus
    t = Tokenizer.from_file(BYTE)
    t.no_truncation()
    t.no_padding()
    want = Counter()
    for i, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op10_trie_bpe(spark, sf_dir).collect()) == want


def least_of_components(rows):
    """Brute force: of rows equal in key and text the least; of documents that near copies join, the least."""
    distinct = {}
    for r in sorted(rows, key=str):
        distinct.setdefault(r[:2] if r[0] is not None else (None, id(r)), r)
    kept = [r for r in distinct.values()]
    order = {t: xxhash.xxh64((t or "").encode(), seed=42).intdigest() for _, t, *_ in kept}
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    named = sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], signed(order[r[1]]) if r[1] is not None else 42))
    sets = [brute_set(r[1], 5) for r in named]
    root = list(range(len(named)))
    find = lambda k: k if root[k] == k else find(root[k])
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [r for k, r in enumerate(named) if root[k] == k] + [r for r in kept if r[0] is None]


def test_pipeline_stages_and_run(spark, corpus, sf_dir):
    rows, _ = corpus
    name = lambda r: str(tuple(r))
    frame = lambda rows: spark.createDataFrame(rows, DOCS).repartition(3)
    quality_stage, language_stage, near_stage, span_stage, pack_stage = (f for _, f in corpus_pipeline.STAGES)
    docs = frame(rows).withColumn("_row", F.lit(1)).withColumn("score", F.lit("clash"))

    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn=F.lit(True))
    sums = [float((np.array(plain_features(r[1])) - model["mean"]) / model["std"] @ model["w"]) for r in rows]
    first = [r for r, s in zip(rows, sums, strict=True) if s >= model["at"]]
    got = quality_stage(spark, docs, sf_dir)
    assert got.columns == corpus_pipeline.COLUMNS and sorted(map(name, got.collect())) == sorted(map(name, first)) and not {r[0] for r in first} & set(range(36, 48))

    second = [r for r in first if exact_language(first, True, r[1])[1] >= 0.3]
    got = language_stage(spark, frame(first).withColumn("lang_pred", F.lit(1)), sf_dir)
    assert sorted(map(name, got.collect())) == sorted(map(name, second)) and all(r[1] and any(c.isalpha() for c in r[1]) for r in second)

    third = least_of_components(second)
    got = near_stage(spark, frame(second).withColumn("id", F.lit("clash")), sf_dir)
    assert sorted(map(name, got.collect())) == sorted(map(name, third)) and len(third) < len(second) - 5

    cleaned = repeats_removed([r[:2] for r in third])
    fourth = [(r[0], t, *r[2:4], len(t) if t is not None else None) for r, (t, gone) in zip(third, cleaned, strict=True) if not (gone and not (t or "").strip(" "))]
    got = span_stage(spark, frame(third).withColumn("removed_units", F.lit(1)), sf_dir)
    assert sorted(map(name, got.collect())) == sorted(map(name, fourth)) and sum(gone > 0 for _, gone in cleaned) >= 2

    def ids(packed):
        out = {}
        for r in packed:
            out.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        return Counter((k[0], b"".join(bytes(r.ids) for r in sorted(v, key=lambda r: r.start))) for k, v in out.items())

    t = Tokenizer.from_file(WORD)
    coded = Counter((r[0], np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for r in fourth)
    assert ids(pack_stage(spark, frame(fourth), sf_dir).collect()) == coded
    assert ids(corpus_pipeline.run(spark, sf_dir).collect()) == coded
    for stage in (quality_stage, language_stage, near_stage, span_stage):
        assert stage(spark, frame(rows).limit(0), sf_dir).count() == 0
    assert pack_stage(spark, frame(rows).limit(0), sf_dir).count() == 0
    import os

    left = os.listdir(shared_dir(spark))
    assert not [x for x in left if x.startswith(("postings", "blocks", "repeated-runs", "small-star"))]  # removed with their job
