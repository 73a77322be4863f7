"""The numbered operators against brute force, on fixtures with nulls, empty and long texts, ties and repeats."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foliomill.llm import language_id, media, ngram_join, packing, quality, sharding, substring_dedup, token_planes, topk, trie_bpe
from foliomill.llm.components import connected_components
from foliomill.llm.word_ids import WordEncoder
from foliomill.session import bound_arrow_batches

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, media string, score double, id string, removed_units string"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    words = [f"{a}{b}" for a in ("ka", "él", "Mo", "ß", "x1") for b in ("ne", "ru", "ti!", "so.", "’s", "🙂")]
    sentence = lambda n: " ".join(rnd.choice(words) for _ in range(n)).rstrip(".") + ". "
    passage = "".join(sentence(13) for _ in range(6))
    texts = ["".join(sentence(rnd.randint(1, 20)) for _ in range(rnd.randint(1, 9))) for _ in range(40)]
    texts += [passage, "Lead. " + passage + "Tail.", passage, texts[0], texts[1] + " more", None, "", " \n\t", "  a   b  \n\n c ", "<|endoftext|> a <|", "A b", "a B", "İΣ\x85x", "0", "word " * 20000]
    texts += ["".join(rnd.choice("ab \n.!é中") for _ in range(60)) for _ in range(20)]
    return [(i, t, "en" if i % 2 else None, "s", None, "clash", 0.5, "clash", "clash") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    bound_arrow_batches(spark, 1 << 16)
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_word_encoder_is_the_library(rows):
    t, e = Tokenizer.from_file(WORD), WordEncoder(WORD, most=20)
    for r in rows:
        assert np.frombuffer(e.encode(r[1]), "<u4").tolist() == t.encode(r[1] or "", add_special_tokens=False).ids


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_planes(docs, rows, planes, none):
    got = {r.doc_id: r for r in token_planes.read_token_files(token_planes.write_token_files(docs, WORD, 1, planes=planes, file_ids=500)).collect()}
    t, start = Tokenizer.from_file(WORD), 0
    for i, text, *_ in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32, bytes(got[i].ids)) == (start, len(ids), zlib.crc32(ids), ids.tobytes())
        start += len(ids)
    assert token_planes.read_token_files(token_planes.write_token_files(none, WORD, 1)).count() == 0


def test_plane_files_of_large_ids_and_null_keys():
    ids = np.array([1, 1 << 20, 5, 1 << 31], "<u4")
    for planes in ("byte", "bit"):
        keys, counts, back = token_planes.unpack_ids(token_planes.pack_ids(ids, [None, 7], [1, 3], planes, chunk=3))
        assert (keys, counts.tolist(), back.tolist()) == ([None, 7], [1, 3], ids.tolist())


def test_packing(docs, rows, none):
    got = packing.pack_documents(docs, WORD, 2, window=128, group_docs=30).collect()
    t, of = Tokenizer.from_file(WORD), {}
    for r in got:
        of.setdefault(r.sequence_id, []).append(r)
    for pieces in of.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 128
    for i, text, *_ in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert b"".join(bytes(r.ids) for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)) == ids
    assert packing.pack_documents(none, WORD, 2).count() == 0


def test_first_fit_decreasing_by_brute_force():
    rnd = random.Random(1)
    lengths = [rnd.randint(1, 50) for _ in range(200)]
    got = packing.first_fit_decreasing(lengths, 50)
    room, want = [], {}
    for i in sorted(range(200), key=lambda i: (-lengths[i], i)):
        b = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
        room += [50] * (b == len(room))
        want[i] = (b, 50 - room[b])
        room[b] -= lengths[i]
    assert got == [want[i] for i in range(200)]


def test_trie(docs, rows, none):
    t = Tokenizer.from_file(BYTE)
    got = {r.doc_id: r for r in trie_bpe.encode_decode(docs, BYTE, trie_bytes=4000).collect()}
    for i, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids
        assert got[i].decoded == t.decode(ids, skip_special_tokens=False)
    assert trie_bpe.encode_decode(none, BYTE).count() == 0


def test_media(spark, docs, rows, none):
    read = {r.doc_id: r for r in media.read_media(media.encode_media(docs).withColumn("status", F.lit("clash"))).collect()}
    for i, text, *_ in rows:
        data = (text or "").encode()
        padded = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        r = read[i]
        assert (bytes(r.payload), r.status, r.codec, r.n_samples, r.duration) == (padded, "ok", "raw", len(padded) // 64, len(padded) // 64)
        assert b"".join(bytes(r.media)[k.offset : k.offset + k.size] for k in r.keyframes) == b"".join(padded[j : j + 64] for j in range(0, len(padded), 1024))
    broken = spark.createDataFrame([(None,), (b"",), (b"\0\0\0\x40moov",), (bytes(media.write_container(bytes(64)))[:-20],)], "media binary")
    assert [r.status.split(":")[0] for r in media.read_media(broken).collect()] == ["null", "no track", "malformed", "malformed"]
    assert media.read_media(media.encode_media(none)).count() == 0


def test_topk(spark):
    rnd = np.random.default_rng(3)
    data = [(int(i), [float(x) for x in rnd.normal(size=8).astype(np.float32)], "x") for i in range(150)]
    data += [(i, [0.5] * 8, "x") for i in range(150, 190)] + [(190, None, "x"), (191, [float("nan")] * 8, "x"), (200, [None] + [1.0] * 7, "x"), (201, [1.0] * 7, "x"), (None, [1.0] * 8, "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, score string").repartition(3)
    queries = df.where("vec_id % 50 = 0")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, queries, k=5, bins=16, block=16, query_block=2).collect()}
    good = [(i, np.floor(256 * np.array(v, np.float64)).astype(int)) for i, v, _ in data[:190]]
    want = {}
    for q, v in good:
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in good if i != q)[:5]
            want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert got == want
    few = df.where("vec_id < 3")
    assert topk.top_k(few, few.where("vec_id = 0"), k=5).count() == 2
    assert topk.top_k(df.limit(0), df.limit(0), k=5).count() == 0


def test_sharding(spark, docs, rows, none):
    many = docs.unionByName(docs.where("doc_id = 3"))
    got = sharding.shard_documents(many, 5).collect()
    for s in range(5):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert len(got) == len(rows) + 1 and all(r.grown_shard in (r.shard, 5) for r in got)
    assert all(r.text_crc32 == zlib.crc32((rows[r.doc_id][1] or "").encode()) for r in got)
    assert sharding.shard_documents(none, 5).count() == 0
    heavy = spark.range(20000).select(sharding.rendezvous(F.col("id"), [1, 2, 0, 1]).alias("s")).groupBy("s").count().collect()
    shares = {r["s"]: r["count"] / 20000 for r in heavy}
    assert 2 not in shares and abs(shares[1] - 0.5) < 0.02 and abs(shares[0] - 0.25) < 0.02


def shingles(text, width):
    w = [x.decode("utf-8", "surrogateescape") for x in re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))]
    return {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def groups(sets, num, den):
    p = {i: i for i in sets}

    def find(x):
        while p[x] != x:
            x = p[x]
        return x

    for a in sets:
        for b in sets:
            if b < a and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                p[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize(("width", "num", "den", "few"), [(3, 90, 100, 16), (5, 4, 5, 1)])
def test_ngram_join(spark, docs, rows, none, monkeypatch, width, num, den, few):
    monkeypatch.setattr(ngram_join, "FEW", few)
    rnd = random.Random(2)
    near = []
    for i in range(60):  # near copies, many of which don't link with each other
        words = [f"w{j}" for j in range(90)]
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(90)] = f"v{rnd.randrange(99)}"
        near.append((1000 + i, " ".join(words)))
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([*near, (None, "a b c d e f")], "doc_id long, text string"))
    got = {r.doc_id: r for r in ngram_join.near_duplicates(df, width, num, den).collect()}
    sets = {i: shingles(t, width) for i, t in [*((r[0], r[1]) for r in rows), *near]}
    want = groups(sets, num, den)
    assert {i: (got[i].n_shingles, got[i].component_id) for i in sets} == {i: (len(sets[i]), want[i]) for i in sets}
    assert got[None].component_id is None
    if few == 1:
        assert ngram_join.near_duplicates(none, width, num, den).count() == 0


@pytest.mark.parametrize(("few", "block"), [(16, 1 << 16), (1, 300)])
def test_ngram_join_counts_every_link(spark, monkeypatch, few, block):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rnd = random.Random(4)
    data = []
    for g, (copies, most) in enumerate([(30, 1), (25, 5), (2, 1), (3, 2), (9, 4)]):  # groups whose copies all link, and others
        for _ in range(copies):
            words = [f"g{g}w{j}" for j in range(90 + rnd.randrange(3))]
            for _ in range(rnd.randint(0, most)):
                words[rnd.randrange(90)] = f"v{rnd.randrange(999)}"
            data.append((len(data), " ".join(words)))
    data += [(len(data) + i, data[i][1]) for i in range(5)]  # equal sets are one class
    got = {r.doc_id: r for r in ngram_join.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 3, 90, 100).collect()}
    sets = {i: frozenset(shingles(t, 3)) for i, t in data}
    classes = set(sets.values())
    want = {i: sum(a != b and 100 * len(a & b) >= 90 * len(a | b) for b in classes) for i, a in sets.items()}
    assert {i: got[i].links for i in sets} == want and max(want.values()) > 15


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 31)} | {100 + i: 100 for i in range(20)}


def repeats_removed(rows: list[tuple]) -> list[tuple[str | None, int]]:
    """Brute force: the text that stays and the units removed of each (key, text), rows equal in both being one document."""
    units = {r: substring_dedup.units(r[1] or "") for r in rows}
    assert all("".join(u) == (text or "") for (_, text), u in units.items())
    spans, first = {}, {}
    hashed = {t: h for t, h in zip(sorted({t or "" for _, t in rows}), range(len(rows)), strict=False)}
    for r in sorted(units, key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1] or ""])):
        of, found, n = units[r], set(), len(units[r])
        words = lambda a, b, of=of: sum(len(u.split()) for u in of[a:b])
        for a in range(n):
            b = next((b for b in range(a + 3, n + 1) if words(a, b) >= 24), None)
            found |= {(a, b)} if b else set()
        for b in range(1, n + 1):
            a = next((a for a in range(b - 3, -1, -1) if words(a, b) >= 24), None)
            found |= {(a, b)} if a is not None else set()
        ends, at = [0], 0  # a sentence with a word ends behind these units
        for s in re.findall(r"[^.!?\n。！？]*(?:[.!?。！？]+|\n|\Z)\s*", r[1] or ""):
            at += len(s)
            if s.split():
                ends.append(next(i + 1 for i in range(n) if len("".join(of[: i + 1])) == at))
        if n and not of[0].split():
            ends[0] = 1
        found |= {(a, b) for a, b in zip(ends, ends[3:], strict=False) if words(a, b) < 24}
        for a, b in sorted(found):
            k = tuple(" ".join(u.lower().split()) for u in of[a:b])
            first.setdefault(k, (r, a))
            spans.setdefault(r, []).append((a, b, k))
    out = []
    for r in rows:
        gone = {u for a, b, k in spans.get(r, []) if first[k] != (r, a) for u in range(a, b)}
        kept = "".join(u for j, u in enumerate(units[r]) if j not in gone)
        out.append((None if r[1] is None else kept.rstrip() if len(units[r]) - 1 in gone else kept, len(gone)))
    return out


def test_substring_dedup(docs, rows, none):
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(docs).collect()}
    for (i, *_), (text, gone) in zip(rows, repeats_removed([r[:2] for r in rows]), strict=True):
        assert (got[i].text, got[i].removed_units) == (text, gone)
    assert got[41].text == "Lead. Tail." and got[42].text == "" and got[40].removed_units == 0 and got[0].media == "clash"
    assert substring_dedup.remove_repeats(none).count() == 0


def test_substring_dedup_short_sentences(spark):
    """Runs of three whole sentences count however short; two don't."""
    shared = "One two. Three four five. Six. "
    data = [(1, "Own words here. " + shared + "More."), (2, shared + "Other end."), (3, "Three four five. Six. Nothing else."), (4, "\n\n" + shared)]
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {1: data[0][1], 2: "Other end.", 3: data[2][1], 4: "\n\n"[:0]} or got[4].strip() == ""
    assert [got[i] for i in (1, 2, 3)] == [data[0][1], "Other end.", data[2][1]]


def test_substring_dedup_scripts_without_spaces(spark):
    rnd = random.Random(2)
    han = lambda n: "".join(chr(rnd.randint(0x4E00, 0x9FA5)) for _ in range(n))
    passage = "".join(han(14) + "。" for _ in range(5))
    data = [(1, han(20) + "。" + passage + han(9) + "。"), (2, passage), (3, han(30) + passage + han(30) + "！")]
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got[1] == data[0][1] and got[2] == "" and passage[20:50] not in got[3] and got[3].startswith(data[2][1][:20]) and got[3].endswith(data[2][1][-20:])


def test_equal_keys_are_documents_of_their_own(spark):
    """Rows of one key with different texts, null keys and rows equal in both, in the operators that compare rows."""
    rnd = random.Random(3)
    sentence = lambda: " ".join(rnd.choice("abcdefgh") + str(rnd.randrange(300)) for _ in range(12)) + ". "
    passage = "".join(sentence() for _ in range(5))
    texts = [passage + sentence(), "".join(sentence() for _ in range(9)), passage, sentence() + passage + sentence() * 2]
    data = [(7, texts[0]), (7, texts[1]), (7, texts[2]), (7, texts[3]), (None, texts[3]), (None, texts[1]), (9, texts[0]), (9, texts[0]), (3, None), (3, "")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text, r.removed_units) for r in substring_dedup.remove_repeats(df).collect()]
    assert len(got) == len(data)
    # every sentence of a passage stands in one place only: the first by key, null keys before
    kept = [t for k, t, _ in got if t and passage[:40] in t]
    assert len(kept) == 1 and sum(1 for k, t, _ in got if k == 9 and t == "") == 2
    assert sum(t == texts[1] for k, t, _ in got if k is None) == 1 and sum(t == "" for k, t, _ in got if k == 7) >= 1
    # the join: texts[0] and its copy link, though a row of the same key is unlike
    near = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df, 3, 9, 10).collect()]
    sizes = [len(brute_set(t, 3)) for t in texts]
    assert sorted(x for x in near if x[0] == 9) == [(9, sizes[0], 7)] * 2 and sorted(x[1] for x in near if x[0] == 7) == sorted(sizes)
    assert all(x[2] is None for x in near if x[0] is None) and sorted(x for x in near if x[0] == 3) == [(3, 0, 3)] * 2
    kept = ngram_join.keep_first(df, 3, 9, 10).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted((k or 0, t or "") for k, t in data if k != 9)


def brute_set(text: str | None, width: int) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())


def test_substring_dedup_mid_sentence(spark):
    rnd = random.Random(8)
    words = lambda n: [rnd.choice("abcdefgh") + str(rnd.randrange(500)) for _ in range(n)]
    data, passages = [], []
    for i in range(40):  # passages of 51 to 80 words, some with full stops, that begin and end inside sentences
        p = words(51 + i % 30)
        for j in range(i % 4):
            p[12 + 13 * j] += "."
        passages.append(p)
        data += [(i, " ".join([*words(i % 23), *p, *words(i % 17)])), (100 + i, " ".join([*words(i % 19 + 1), *p, *words(i % 11 + 1), "end. Own", *words(30)]))]
    long = words(100)
    data += [(300, " ".join(long)), (301, " ".join([long[0], "inserted", *long[1:]])), (302, " ".join(long[1:])), (303, " ".join([long[0][:1], long[0][1:], *long[1:]]))]
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    texts = dict(data)
    for i, p in enumerate(passages):
        assert got[i].text == texts[i] and got[100 + i].text.endswith(texts[100 + i][texts[100 + i].index("Own") :])
        assert len(texts[100 + i].split()) - len(got[100 + i].text.split()) >= len(p) - 4 * (substring_dedup.WINDOW - 1)
    assert got[300].text == texts[300] and all(len(got[i].text.split()) <= 2 * substring_dedup.WINDOW for i in (301, 302, 303))


def test_language(spark, none):
    rnd = random.Random(4)
    parts = {"en": ("the", "ing", "wh", "and"), "de": ("sch", "ung", "ä", "ein"), "fr": ("eau", "oi", "é", "que")}
    make = lambda x: " ".join("".join(rnd.choice(parts[x]) for _ in range(3)) for _ in range(40))
    data = [(i, make(x), x) for i, x in enumerate(list(parts) * 60)] + [(900, None, "en"), (901, "12 !?", None), (902, "", "de")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language_id.fit(df, learn=F.col("doc_id") < 90)
    got = {r.doc_id: r for r in language_id.predict(df, model).collect()}
    assert all(got[i].lang_pred == x and 0 <= got[i].score <= 1 for i, _, x in data[90:180])
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert language_id.keep_known(df, model).count() == 180
    assert language_id.predict(df, language_id.fit(none)).where("lang_pred = 'und'").count() == df.count()


def test_quality(spark, none):
    rnd = random.Random(6)
    good = lambda: " ".join(rnd.choice(["plain", "words", "of", "text."]) for _ in range(60))
    bad = lambda: " ".join(rnd.choice(["SHOUT!!", "a###", "b***", "|"]) for _ in range(60))
    data = [(i, bad() if i % 4 == 0 else good()) for i in range(400)] + [(900, None), (901, "")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(400)] + [(5, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(df, labels, learn=F.col("doc_id") % 2 == 0)
    got = {r.doc_id: r.score for r in quality.score(df, model).collect()}
    assert all((got[i] >= 0.3) == (i % 4 > 0) for i in range(400)) and all(0 <= s <= 1 for s in got.values())
    assert quality.keep_good(df, model).where("doc_id < 400").count() == 300
    blank = quality.fit(none, labels, learn=F.lit(True))
    assert quality.score(df, blank).where("score = 1").count() == len(data)


def test_digest_of_trie_query(spark, rows):
    from foliomill.llm import queries

    r = queries.op10_trie_bpe(spark, "/root/testdata/sf0.001").orderBy("doc_id").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.col("doc_id") == r.doc_id).first().text
    ids = Tokenizer.from_file(BYTE).encode(text, add_special_tokens=False).ids
    assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4")).hexdigest() and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.cut(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
        assert out.columns == corpus_pipeline.COLUMNS, name
        assert 0 < out.count() <= kept
        docs, kept = out, out.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert pieces.select("doc_id").distinct().count() == kept
