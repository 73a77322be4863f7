"""Registered queries against brute force over small tables; odd column names; large components."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import WORD, repeats_removed
from test_ngram_clusters import plain, templates
from tokenizers import Tokenizer

from foliomill.llm import ann, fim, language_id, media, ngram_join, packing, quality, queries, sharding, substring_dedup, token_planes, topk, trie_bpe, vector_codes


def texts():
    rnd = random.Random(21)
    word = lambda: rnd.choice(["alpha", "beta", "Gamma", "delta", "Straße", "é𝒳", "one", "two"])
    sentence = lambda: " ".join(word() for _ in range(rnd.randint(4, 14))).capitalize() + rnd.choice([". ", "! ", ".\n"])
    passage = "".join(sentence() for _ in range(6))
    out = ["".join(sentence() for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    out += [sentence() + passage + sentence() for _ in range(4)] + [out[3]] * 3 + [out[4].replace("alpha", "beta", 1)]
    return [*out, *templates(rnd, 2, 5, 40, 70), "", None, " ", "one", "long words here. " * 3000]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("registered"))
    spark.createDataFrame([(3 * i, t, "x") for i, t in enumerate(texts())], "doc_id long, text string, lang string").repartition(3).write.parquet(f"{d}/documents.parquet")
    return d


def test_substring_dedup_query(spark, sf_dir):
    rows = [(3 * i, t) for i, t in enumerate(texts())]
    got = {r.doc_id: (r.text, r.removed_units) for r in queries.op1_substring_dedup(spark, sf_dir).collect()}
    assert got == {i: kept for (i, _), kept in zip(rows, repeats_removed(rows), strict=True)}


def test_ngram_join_query(spark, sf_dir):
    want = plain([t or "" for t in texts()], 3, 90, 100)
    got = {r.doc_id: (r.component_id // 3, r.links) for r in queries.op2_ngram_jaccard_join(spark, sf_dir).collect()}
    assert got == {3 * i: w for i, w in enumerate(want)}


def test_packing_query(spark, sf_dir):
    library = Tokenizer.from_file(WORD)
    library.no_truncation()
    ids = {3 * i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts())}
    pieces, places = defaultdict(list), defaultdict(list)
    for r in queries.op7_packing(spark, sf_dir).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.length == len(part) > 0 and r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        pieces[r.doc_id].append((r.start, r.length))
        places[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for i, found in pieces.items():
        assert [s for s, _ in sorted(found)] == np.append(0, np.cumsum([n for _, n in sorted(found)])[:-1]).tolist() and sum(n for _, n in found) == len(ids[i])
    for found in places.values():
        assert [s for s, _ in sorted(found)] == np.append(0, np.cumsum([n for _, n in sorted(found)])[:-1]).tolist() and sum(n for _, n in found) <= 4096
    assert len(places) <= 1.1 * sum(map(len, ids.values())) / 4096 + 1


def test_media_query_of_stored_bytes(spark, sf_dir):
    """media_bytes, media_sha256 and feature are those of the container that the text's frames give."""
    got = {r.doc_id: r for r in queries.op5_media_columns(spark, sf_dir).collect()}
    for i, t in enumerate(texts()):
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        stored = media.write_container(payload)
        track = media.read_tracks(stored)[0]
        r, n = got[3 * i], len(payload) // 64
        frames = list(range(0, n, 16))
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        codec, shape, duration, samples, keys, _ = r.feature.split(" ")
        assert (codec, shape, int(samples), int(keys)) == (track["codec"], "8x8", n, len(frames)) and int(duration.split("/")[0]) == track["duration"]
        assert stored.count(payload) == 1  # lossless, in order
        where = ",".join(f"{stored.find(payload) + 64 * f}+64" for f in frames)
        assert r.feature.endswith(f" {zlib.crc32(where.encode())}")


def test_columns_of_any_name(spark):
    """Dots, backticks, names that steps use inside, and names of results."""
    odd = ["a.b", "c`d", "_row", "_ROW_", "_spans", "_x0", "id", "state"]
    names = ", ".join("`" + c.replace("`", "``") + "` int" for c in odd)
    docs = spark.createDataFrame([(1, "some words of a text", "en", *range(8)), (2, None, "en", *range(8)), (3, "some words of a text", "en", *range(8))], f"doc_id long, text string, lang string, {names}")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    kept = lambda df: [[r[c] for c in odd] for r in df.collect()]
    model = language_id.fit(docs)
    assert kept(substring_dedup.remove_repeats(docs)) == [list(range(8))] * 3
    assert kept(ngram_join.keep_first(docs, 5, 4, 5)) == [list(range(8))] * 2
    assert kept(language_id.keep_known(docs, model)) == [list(range(8))] * 2
    assert len(kept(quality.keep_good(docs, quality.fit(docs, labels, F.lit(True))))) >= 0
    assert kept(fim.restore(fim.fill_in_middle(docs))) == [list(range(8))] * 3
    stored = media.encode_media(docs).join(docs.drop("text"), "doc_id")
    assert kept(media.read_media(stored)) == [list(range(8))] * 3
    assert ngram_join.near_duplicates(docs, 5, 4, 5).count() == language_id.predict(docs, model).count() == token_planes.read_token_files(token_planes.write_token_files(docs, WORD, end_id=1)).count() == 3
    assert packing.pack_documents(docs, WORD, end_id=2).count() == sharding.shard_documents(docs, 4).count() == trie_bpe.encode_decode(docs, queries.tokenizer_path("byte_bpe_50k.json")).count() == 3
    vectors = spark.createDataFrame([(i, [1.0, float(i)], *range(8)) for i in range(3)], f"vec_id long, embedding array<double>, {names}")
    assert kept(vector_codes.compress(vectors, parts=2).rows) == [list(range(8))] * 3
    assert topk.top_k(vectors, vectors, k=2).count() == ann.nearest(vectors, vectors, k=2).count() == 6


def test_topk_of_large_components(spark):
    rows = [(0, [1e9, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [3e15, 1.0]), (4, [-1e300, 5e15]), (5, [1e308, 1e308]), (6, [0.1, 0.2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(np.floor(x * 256)) if abs(x * 256) < 2**53 else int(min(max(x * 256, -1.7976931348623157e308), 1.7976931348623157e308)) for x in v] for i, v in rows}
    want = []
    for q, v in whole.items():
        best = sorted((-max(-topk.MOST, min(topk.MOST, sum(a * b for a, b in zip(v, c, strict=True)))), i) for i, c in whole.items() if i != q)[:4]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    with np.errstate(over="ignore"):
        assert sorted(map(tuple, topk.top_k(df, df, k=4).collect())) == sorted(want)
    assert Counter(s for *_, s in want)[topk.MOST] > 0
