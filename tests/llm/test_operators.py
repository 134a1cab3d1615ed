"""The training-data operators against brute force, on small and odd inputs."""

import hashlib
import os
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from staygrid.llm import chat, common, components, huffman, language, media, mixing, packing, quality, simhash, substrings, vectors
from staygrid.llm.tokens import ChunkEncoder, tokenizer_path

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, score double, cut int"
ODD = [
    "a  b\n\n c \t d  e\x1c f\x85\n g", "<|endoftext|> x", "  lead", "trail  \n", "'s it's don't", "　a b", "é ́x", "", " ", "İ ΣΑΣ a\r\n b", "x​ y   z",
    "Ünïcode ×÷ ÀÉ! é Å 123abc 4½ don'T I'LL", "日本語 テスト", "a\n\n\nb   c", "\x00\x01 \x7f", "word" * 400,
]


def _documents(spark, n=40, seed=3):
    """Documents with clean and junk texts, copies, nulls, ties and columns whose names clash."""
    r = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(200)]
    rows = []
    for d in range(n):
        words = [r.choice(vocabulary) for _ in range(r.randrange(0, 120))]
        rows.append((d, " ".join(words), r.choice(["en", "de"]), f"src{d % 5}", 0.5, 1))
    rows += [(n, rows[0][1], "en", "src1", None, None), (n + 1, None, None, None, None, None), (n + 2, "", "en", "src0", 0.1, 2), (n + 3, " \n ", "en", "x", 0.1, 2)]
    rows += [(None, rows[1][1], "de", "src1", 0.2, 3), ((1 << 60) + 1, "large id", "de", "src1", 0.2, 3), rows[2], (n + 4, " ".join(vocabulary * 3), "de", "src2", 0.2, 3)]
    return rows, spark.createDataFrame(rows, DOCS).repartition(3)


def _empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize(("name", "words"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_tokens_equal_the_library(name, words):
    mine, library = ChunkEncoder(tokenizer_path(name), 4, words), Tokenizer.from_file(tokenizer_path(name))
    special = [f"{a}{t}{b}" for t in ("<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>") for a in ("", "A ", "é", "日本") for b in ("", " b", "\n\n c é")]
    assert mine.known_rules
    for text, ids in zip([*ODD, *special], mine.encode([*ODD, *special]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_unknown_tokenizer_files_take_the_library_path(tmp_path):
    import json

    spelt = json.loads(Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json")).to_str())
    spelt["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "Digits", "individual_digits": True}, spelt["pre_tokenizer"]]}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spelt))
    mine, library = ChunkEncoder(str(path)), Tokenizer.from_file(str(path))
    assert not mine.known_rules
    assert np.frombuffer(mine.encode(["room 1234"])[0], "<u4").tolist() == library.encode("room 1234", add_special_tokens=False).ids


# --- op1 ------------------------------------------------------------------------------------


def test_media_digests(spark):
    rows, docs = _documents(spark)
    long = [(800, "é" * 96, "en", "s", 0.0, 0), (801, "%PDF- BM RIFF PK\x03\x04 " * 100_000, "en", "s", 0.0, 0)]
    out = media.digests(media.sniff_media(media.store_texts(docs.unionByName(spark.createDataFrame(long, DOCS))))).collect()

    def want(doc_id, text):
        raw = (text or "").encode()
        payload = raw.ljust(max(-(-len(raw) // 192), 1) * 192)
        head = b"RIFF" + (len(payload) + 36).to_bytes(4, "little") + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 8000, 1, 8) + b"data" + len(payload).to_bytes(4, "little")
        corrected = "false" if raw and len(raw) % 192 == 0 else "true"
        feature = f"type=audio/wav;corrected={corrected};embedded=;fill={len(raw) / len(payload):.4f}"
        return (doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(head + payload), hashlib.sha256(head + payload).hexdigest(), feature)

    assert sorted((tuple(r) for r in out), key=str) == sorted((want(d, t) for d, t, *_ in [*rows, *long]), key=str)
    assert media.digests(media.sniff_media(media.store_texts(_empty(spark)))).count() == 0
    clash = media.sniff_media(spark.createDataFrame([(b"x", 1)], "media binary, sniffed int"))
    assert clash.columns == ["media", "sniffed"] and clash.first()["sniffed"]["type"] is None


def _png() -> bytes:
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b"")


def test_sniffing_corrects_and_carves():
    machine, png, wav = media.automaton(), _png(), media.wave(b"BM not a bitmap, RIFF neither")
    gif = b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0, 0, 0) + b"\x2c" + struct.pack("<HHHHB", 0, 0, 1, 1, 0) + b"\x02\x02\x4c\x01\x00\x3b"
    gz = zlib.compressobj(wbits=31)
    gz = gz.compress(b"x" * 1000) + gz.flush()
    assert media.sniff(wav, machine) == [(0, len(wav), "audio/wav")]
    parts = media.sniff(b"text " + png + b" BM " + gif + b"--" + gz + b"tail", machine)
    assert [(n, k) for _, n, k in parts] == [(len(png), "image/png"), (len(gif), "image/gif"), (len(gz), "application/gzip")]
    broken = bytearray(png)
    broken[20] ^= 1
    assert media.sniff(bytes(broken), machine) == [] and media.sniff(png[:-3], machine) == [] and media.sniff(b"", machine) == []
    pdf = b"%PDF-1.4\n1 0 obj\nendobj\nstartxref\n9\n%%EOF"
    updated = pdf + b"\n2 0 obj\nendobj\nstartxref\n50\n%%EOF"
    parts = media.sniff(b"a %%EOF " + updated + b"\nnoise " + pdf + b" %PDF-1.0 no end", machine)
    assert [(at, n, k) for at, n, k in parts] == [(8, len(updated), "application/pdf"), (8 + len(updated) + 7, len(pdf), "application/pdf")]
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xda\x00\x02data\xff\x00more\xff\xd9"
    assert media.sniff(b"x" + jpeg + b"y", machine) == [(1, len(jpeg), "image/jpeg")] and media.sniff(jpeg[:-1], machine) == []
    inside = media.wave(png)
    assert [k for _, _, k in media.sniff(inside, machine)] == ["audio/wav", "image/png"] and media.samples(inside) == png


def test_check_sums_from_stretches():
    r = random.Random(4)
    for n in (0, 1, 5, media.STRETCH, 3 * media.STRETCH + 7, 90_000):
        data = r.randbytes(n)
        blob = media.Blob(data, {})
        for _ in range(30):
            i, j = sorted((r.randrange(n + 1), r.randrange(n + 1)))
            assert blob.crc32(i, j) == zlib.crc32(data[i:j])


def test_hostile_blobs_take_linear_time():
    """Magic numbers that all lead into the same chains: ten times the bytes, about ten times as long."""
    import time

    machine = media.automaton()
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", bytes(13))
    for make in (
        lambda n: b"GIF87aAAAAAAA!A" * (n // 15), lambda n: (png + struct.pack(">I", n // 2) + b"IDAT") * (n // 90) + bytes(n // 2 + 99),
        lambda n: (b"RIFF" + struct.pack("<I", n - n // 9) + b"AVI ") * (n // 15) + bytes(n - n // 15 * 12), lambda n: b"\xff\xd8\xff\xda\x00\x08" * (n // 12) + bytes(n // 2) + b"\xff\xd9",
    ):
        took = []
        for n in (60_000, 600_000):
            begin = time.process_time()
            media.sniff(make(n), machine)
            took.append(time.process_time() - begin)
        assert took[1] < 30 * max(took[0], 0.02)


def test_chains_may_be_entered_anywhere():
    """Files within one another's bytes are judged as each alone would be."""
    r, machine = random.Random(9), media.automaton()
    wav = lambda body: b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body
    part = lambda name, n: name + struct.pack("<I", n) + bytes(n + n % 2)
    gif = b"GIF89a" + bytes([1, 0, 1, 0, 0, 0, 0]) + b"\x21\xf9\x04" + bytes(4) + b"\0\x2c" + bytes(9) + b"\x02\x03abc\0;"
    jpeg = b"\xff\xd8\xff\xe0\x00\x05abc\xff\xda\x00\x04xx\x01\xff\x00\x02\xff\xd1\x03\xff\xd9"
    for _ in range(300):
        k = r.randrange(5)
        files = [wav(part(b"fmt ", 16) + part(b"LIST", k) * k + part(b"data", r.randrange(9))), gif, jpeg]
        r.shuffle(files)
        junk = [r.randbytes(r.randrange(4)) for _ in files]
        blob, want, at = b"", [], 0
        for j, f in zip(junk, files, strict=True):
            at += len(j)
            want.append((at, len(f)))
            blob, at = blob + j + f, at + len(f)
        found = {(a, n) for a, n, _ in media.sniff(b"\x00" + blob, machine)}
        assert {(a + 1, n) for a, n in want} <= found
    bad = wav(part(b"fmt ", 16) + part(b"LIST", 4))
    assert media.sniff(bad, machine) == [] and media.sniff(bad[:-1] + b"\x01", machine) == []


# --- op2 ------------------------------------------------------------------------------------


def test_quality_learns_and_holds_out(spark):
    r = random.Random(1)
    rows, labels = [], []
    for d in range(300):
        words = [r.choice(["alpha", "beta", "gamma", "delta", "one", "two"]) + r.choice("aeiou") for _ in range(r.randrange(20, 200))]
        bad = d % 4 == 0
        if bad:
            at = r.randrange(0, len(words) - 10)
            words[at : at + 40] = [w.upper() + "!!" for w in words[at : at + 40]]
        rows.append((d, " ".join(words)))
        labels.append((d, 0 if bad else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    held = [d for d in got if zlib.crc32(str(d).encode()) % 4 == 2]
    assert len(held) > 40 and np.mean([(got[d] >= 0.5) == (d % 4 != 0) for d in held]) > 0.95
    odd_rows, odd = _documents(spark)
    scored = quality.score(odd, model).collect()
    assert len(scored) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in scored)
    assert "cut" in scored[0].asDict() and quality.score(_empty(spark), model).count() == 0
    none = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.score(docs, none).first()["score"] == 0.5


def test_quality_of_a_text_whatever_its_neighbours():
    texts = ["short text", " \n" * 3000, "", "  lead and trail\t\t", "word " * 200, None, "\n\nA b!", "é", ""]
    alone = [quality._describe([(t or "").encode()]) for t in texts]
    for order in (range(9), range(8, -1, -1), (0, 1, 4, 1, 4, 0), (2, 2, 0), (0, 3, 2), (1,)):
        x, sizes = quality._describe([(texts[k] or "").encode() for k in order])
        assert sizes.tolist() == [alone[k][1][0] for k in order]
        assert (x == np.concatenate([alone[k][0] for k in order])).all()
    blank, lead = quality._CLASS[32], quality._CLASS[10]
    assert alone[1][0][0, [blank, lead]].tolist() == [0.5, 0.5] and alone[6][0][0, lead] == np.float32(2 / 6)
    assert alone[0][0][0, blank] == np.float32(1 / 10)


def _plain_features(text):
    """What `quality` says of each passage, spelt out for one text."""
    import math

    data = (text or "").encode()
    spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    groups = [spans[i : i + 64] for i in range(0, len(spans), 64)] or [[]]
    edges = [0, *(g[0][0] for g in groups[1:]), len(data)]
    out = []
    for k, group in enumerate(groups):
        classes = [0] * quality._CLASSES
        for byte in data[edges[k] : edges[k + 1]]:
            classes[quality._CLASS[byte]] += 1
        row = [c / max(sum(classes), 1) for c in classes]
        words, n = [data[a:b] for a, b in group], max(len(group), 1)
        pairs = list(zip(words, words[1:], strict=False))
        upper = lambda w: sum(chr(b).isupper() for b in w if b < 128)
        row += [math.log1p(len(words)), sum(map(len, words)) / n / 10, len(set(words)) / n, max(map(words.count, words), default=0) / n, len(set(pairs)) / n, sum(a == b for a, b in pairs) / n]
        row += [sum(w[0] < 128 and chr(w[0]).isupper() for w in words) / n, sum(upper(w) >= 2 and 2 * upper(w) >= len(w) for w in words) / n, sum(quality._CLASS[w[-1]] > 4 for w in words) / n]
        out.append(row)
    return out


def test_quality_features_spelt_out():
    texts = ["", " \n", "One two two THREE!! x\ty 4é", None, "  " + "Aa b, " * 150 + "\n", "w" * 3000, " ".join(f"w{i % 7}" for i in range(64)), "a " * 64 + "b"]
    want = [_plain_features(t) for t in texts]
    for chunk in (1 << 18, 200, 40, 1):
        got = [part for x, sizes in quality.describe(texts, chunk) for part in np.split(x, np.cumsum(sizes)[:-1])]
        assert len(got) == len(texts)
        for g, w in zip(got, want, strict=True):
            assert g[:, : quality._CLASSES + 9] == pytest.approx(np.array(w), abs=1e-6) and g.shape[0] == len(w)
            assert g[:, quality._CLASSES + 9 :].sum(1) == pytest.approx([float(len(w) > 1 or r[quality._CLASSES] > 0) for r in w], abs=1e-5)


def test_attention_spelt_out_and_its_gradient():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, 5)).astype(np.float32) for n in (1, 3, 2, 5) * 30]
    labels = np.array([float(b[:, 0].max() > 0.8) for b in bags])
    model = quality.fit(bags, labels)
    x, sizes = np.concatenate(bags), np.array([len(b) for b in bags])
    p = model.score(x, sizes)
    assert ((p > 0.5) == (labels > 0.5)).mean() > 0.85
    w, sigmoid = model.weights, lambda z: 1 / (1 + np.exp(-z))
    for k, bag in enumerate(bags[:8]):
        h = [np.tanh((row - w["mean"]) / w["scale"] @ w["enc"] + w["enc0"]) for row in bag]
        a = np.exp([np.tanh(v @ w["v"]) * sigmoid(v @ w["u"]) @ w["w"] for v in h])
        assert p[k] == pytest.approx(sigmoid(sum(u * v for u, v in zip(a / a.sum(), h, strict=True)) @ w["out"] + w["out0"][0]))

    def loss():
        p = model.forward(x, sizes)["p"]
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    grad = quality.gradient(model, x, sizes, labels)
    for name, g in grad.items():
        for at in [tuple(rng.integers(0, n) for n in g.shape) for _ in range(4)]:
            kept, values = w[name][at], []
            for step in (1e-5, -1e-5):
                w[name][at] = kept + step
                values.append(loss())
            w[name][at] = kept
            assert g[at] == pytest.approx((values[0] - values[1]) / 2e-5, rel=1e-3, abs=1e-8), name


def test_quality_sample_is_of_whole_documents(spark):
    docs = spark.createDataFrame([(d, "word " * (64 * (1 + d % 3)) + ("Bad!! " * 9 if d % 2 else "")) for d in range(60) for _ in range(1 + 3 * (d == 1))], "doc_id long, text string")
    labels = spark.createDataFrame([(d, d % 2) for d in range(60)], "doc_id long, quality int")
    seen = {}
    real, quality.fit = quality.fit, lambda bags, y: seen.update(bags=bags, y=y) or real(bags, y)
    try:
        quality.train(docs, labels, passages=100)
        some, least = [len(b) for b in seen["bags"]], quality.train(docs, labels, passages=1)
        one = [len(b) for b in seen["bags"]]
        quality.train(docs, labels)
    finally:
        quality.fit = real
    every = [d for d in range(60) if zlib.crc32(str(d).encode()) % 4 != 2]
    assert [len(b) for b in seen["bags"]] == [1 + d % 3 + (d % 2) for d in every] and seen["y"].tolist() == [d % 2 for d in every]
    assert some == [min(len(b), 2) for b in seen["bags"]] and one == [1] * len(every) and least.weights is not None  # no document goes


def test_long_labelled_documents_are_learned_from(spark):
    """A document of any length, first in the order of the sample, takes none of the others' place, and all of it counts."""
    ids = [d for d in range(600) if zlib.crc32(str(d).encode()) % 4 != 2][:400]
    docs = spark.createDataFrame([(d, ("plain words here " * 30 if d % 2 else "BAD!! 99 %% " * 30) * (400 if d < 3 else 1)) for d in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(d, d % 2) for d in ids], "doc_id long, quality int")
    model = quality.train(docs, labels, passages=1000)
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert model.weights is not None and all((scores[d] > 0.7) == (d % 2 == 1) for d in ids)
    r = np.random.default_rng(0)
    for n, most in ((10, 3), (7, 7), (5, 9), (1000, 33), (1, 1)):
        bag = r.random((n, 4)).astype(np.float32)
        out = quality.pooled(bag, most)
        assert len(out) == min(n, most) and (n <= most or out.mean(0) == pytest.approx(bag.mean(0), abs=0.05))
    for _ in range(200):
        sizes, limit = r.integers(1, 40, r.integers(1, 30)), int(r.integers(1, 300))
        most = quality.allowance(sizes, limit)
        assert most >= 1 and np.minimum(sizes, most).sum() <= max(limit, len(sizes)) and (most >= sizes.max() or np.minimum(sizes, most + 1).sum() > limit)
    assert quality.allowance(np.zeros(0, np.int64), 5) == 1


# --- op3 ------------------------------------------------------------------------------------


def _cut(rows):
    first = {}
    for d, t, *_ in sorted((x for x in rows if x[0] is not None), key=lambda x: x[0]):
        w = WORDS.findall(t or "")
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), d)
    out = []
    for d, t, *_ in rows:
        w = WORDS.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - 49 if d is not None else 0):
            if first[tuple(w[i : i + 50])] < d:
                gone[i : i + 50] = [True] * 50
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((d, len(w), len(w) - len(kept), " ".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [40_000, 200, 0])
def test_substrings_equal_brute_force(spark, hot):
    rows, _ = _documents(spark)
    r = random.Random(9)
    passage = [f"p{r.randrange(99)}" for _ in range(80)]
    rows += [(100 + d, " ".join(passage[d % 20 :] + ["x"] * (d * 9) + ["x", "y"] * (d * 5)), "en", "s", 0.0, 0) for d in range(12)]
    rows += [(103, rows[0][1], "en", "s", 0.0, 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    out = substrings.remove_repeats(docs, hot).collect()
    got = sorted(((x["doc_id"], x["cut"]["n_words"], x["cut"]["n_removed"], x["cut"]["kept"]) for x in out), key=str)
    assert got == _cut(rows) and sum(g[2] for g in got) > 0


def test_long_repetition_comes_in_chunks(spark):
    import pandas as pd

    n = 3 * substrings.CHUNK
    packed = b" ".join([b"x"] * (n + 49 + 5))
    parts = list(substrings._digests(iter([pd.DataFrame({"content": ["c"], "first": [1], "packed": [packed]})])))
    assert [sum(map(len, p["at"])) for p in parts] == [substrings.CHUNK] * 3 + [5]
    assert sorted(i for p in parts for at in p["at"] for i in at) == list(range(n + 5))
    rows = [(1, "a " + "x " * (2 * substrings.CHUNK)), (2, "x " * substrings.CHUNK + "b"), (3, "x " * 49 + "c"), (4, "y " * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], *r["cut"]) for r in substrings.remove_repeats(docs, 200).collect())
    assert got == _cut(rows) and got[1][2:] == (substrings.CHUNK, "b")


def test_substrings_of_nothing(spark):
    assert substrings.remove_repeats(_empty(spark)).count() == 0


# --- op4 ------------------------------------------------------------------------------------


def test_rows_of_one_id_are_dealt_to_all_partitions(spark):
    docs = spark.range(4000, numPartitions=4).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.lit("one and the same text").alias("text"))
    blocks = huffman.tokenize_blocks(docs, tokenizer_path("word_bpe_49k.json"), True, 1)
    held = [r["n"] for r in blocks.groupBy("part").agg(F.sum("n_docs").alias("n")).collect()]
    assert sum(held) == 4000 and len(held) == 4 and max(held) < 1500
    out = huffman.huffman_round_trip(docs, tokenizer_path("word_bpe_49k.json"))
    assert [r["doc_id"] for r in out.orderBy("start").collect()] == [None] * 2000 + list(range(0, 4000, 2))


def test_huffman_round_trip(spark):
    rows, docs = _documents(spark)
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = sorted((str(d), np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for d, t, *_ in rows)
    out = huffman.huffman_round_trip(docs, tokenizer_path("word_bpe_49k.json")).collect()
    assert sorted((str(r["doc_id"]), bytes(r["ids"])) for r in out) == want
    out.sort(key=lambda r: r["start"])
    ends = [r["start"] + len(r["ids"]) // 4 for r in out]
    assert [r["start"] for r in out] == [0, *ends[:-1]]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in out]
    assert ids == sorted(ids)
    assert huffman.huffman_round_trip(_empty(spark), tokenizer_path("word_bpe_49k.json")).count() == 0


def test_files_decode_elsewhere(spark, tmp_path):
    import subprocess
    import sys

    rows, docs = _documents(spark)
    blocks = huffman.tokenize_blocks(docs, tokenizer_path("word_bpe_49k.json"), True, 1)
    path = huffman.write_files(blocks, huffman.global_code(blocks), f"file://{tmp_path}/ids")
    alone = f"""
import glob, pyarrow.parquet as pq
from staygrid.llm import huffman
code = huffman.Code(huffman.unpack_code(pq.read_table(glob.glob("{tmp_path}/ids/code/*.parquet")[0])["code"][0].as_py()))
n = 0
for f in glob.glob("{tmp_path}/ids/blocks/*.parquet"):
    for block in pq.read_table(f)["content"].to_pylist():
        docs, sizes, ids = huffman.unpack_block(code, block)
        n += len(docs)
        assert sum(sizes) == len(ids) and ids[sum(sizes) - 1] == 1
print(n)
"""
    out = subprocess.run([sys.executable, "-c", alone], capture_output=True, text=True, check=True)
    assert int(out.stdout) == len(rows) == huffman.read_files(spark, path).count()
    with pytest.raises(ValueError):
        huffman.unpack_code(b"SGC0" + huffman.pack_code(np.ones(4, np.uint8))[4:])


def test_code_lengths_are_optimal_within_the_limit():
    rng = np.random.default_rng(1)
    for counts in ([5], [0, 3], [1, 1], [1, 2, 4, 8, 16, 32, 64], rng.integers(0, 1000, 300).tolist(), [2**i for i in range(40)]):
        lengths = huffman.code_lengths(np.array(counts))
        used = lengths[lengths > 0].astype(int)
        assert used.max() <= 16 and (len(used) < 2 or sum(2.0**-x for x in used) == 1.0)
        if max(counts) < 2**16:
            import heapq

            heap, cost = [c for c in counts if c], 0
            heapq.heapify(heap)
            while len(heap) > 1:
                a = heapq.heappop(heap) + heapq.heappop(heap)
                cost += a
                heapq.heappush(heap, a)
            assert len(used) < 2 or int((lengths.astype(int) * np.array(counts)).sum()) == cost
        code = huffman.Code(lengths)
        ids = rng.choice(np.flatnonzero(counts), 1000)
        block = huffman.pack_block(code, 2, huffman.pack_head([1, None], [400, 600]), ids)
        doc_ids, sizes, back = huffman.unpack_block(code, block)
        assert doc_ids == [1, None] and sizes == [400, 600] and (back == ids).all()


# --- op5 ------------------------------------------------------------------------------------


def test_forward_sums_all_segmentations():
    """Against every segmentation, with pieces taken from the vocabulary file itself."""
    import math
    from functools import cache

    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model = language.fit(path, {"a": {"the": 5, "then": 2, "hat": 1, "representation": 3}, "b": {"die": 3, "dann": 2}})
    of = {p: i for i, p in enumerate(language.Pieces(path).texts)}
    file = sentencepiece.SentencePieceProcessor(model_file=path)
    vocabulary = {file.id_to_piece(i).lower() for i in range(3, file.get_piece_size()) if not file.is_byte(i)}
    assert max(map(len, of)) == 16 and "▁representation" in of

    def total(word, column):
        text = "▁" + word

        @cache
        def log_from(at):
            if at == len(text):
                return 0.0
            terms = [math.log(model.probability[of[p], column]) + log_from(at + n) for n in range(1, 40) if at + n <= len(text) and (p := text[at : at + n]) in vocabulary]
            if text[at] not in vocabulary:
                terms.append(math.log(language.FLOOR) + log_from(at + 1))
            top = max(terms)
            return top + math.log(sum(math.exp(t - top) for t in terms))

        for at in range(len(text), -1, -20):  # shallow recursion
            log_from(at)
        return log_from(0)

    for word in ("then", "dann", "x", "一a", "representation", "the" * 13, "hat" * 14, "representation" * 9, "ж" * 300 + "the", "thedie" * 1500):
        scores = model.word_scores([word, "x", word])
        assert (scores[0] == scores[2]).all()
        for column in (0, 1):
            assert scores[0, column] == pytest.approx(total(word, column), rel=1e-9), word


def test_long_words_are_learned_by_the_same_rule():
    """Expected counts of a word by logarithms equal those beside others of its length; two scripts of 60-letter runs are told apart."""
    path = language.public_tokenizers.path("piece_bpe_32k.model")
    counts = {"thethethe" * 3: 4, "representation" * 2: 1, "жthe": 2, "on": 5}
    before = language.LONG
    try:
        short = language.learn(language.Pieces(path), counts)
        language.LONG = 1
        assert language.learn(language.Pieces(path), counts) == pytest.approx(short, rel=1e-9)
    finally:
        language.LONG = before
    huge = language.learn(language.Pieces(path), {"the" * 20_000: 1, "on": 1})
    assert np.isfinite(huge).all() and huge.sum() == pytest.approx(1)


def test_languages_of_long_words_alone_and_many_languages(spark):
    r = random.Random(8)
    letters = {"x": "abcdefghijklm", "y": "nopqrstuvwxyz"}
    rows = [(d, " ".join("".join(r.choice(letters["xy"[d % 2]]) for _ in range(60)) for _ in range(6)), "xy"[d % 2]) for d in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {x["doc_id"]: x["language"]["lang_pred"] for x in language.identify(docs, language.train(docs)).collect()}
    assert all(out[d] == "xy"[d % 2] for d in range(160))
    words = ["".join(chr(97 + (i // 26**k) % 26) for k in range(2)) * 3 for i in range(300)]
    many = spark.createDataFrame([(d, f"{words[d % 300]} " * 4, f"lang{d % 300:03d}") for d in range(1800)], "doc_id long, text string, lang string")
    model = language.train(many)
    assert len(model.langs) == 300
    out = {x["doc_id"]: x["language"]["lang_pred"] for x in language.identify(many.where("doc_id < 300"), model).collect()}
    assert np.mean([out[d] == f"lang{d:03d}" for d in range(300)]) > 0.95


def test_language_learns(spark):
    r = random.Random(2)
    parts = {"en": ["the", "ing", "and", "tion", "er"], "de": ["der", "ung", "sch", "ein", "ich"], "es": ["ción", "que", "ado", "los"]}
    rows = [(d, " ".join("".join(r.choice(parts[g]) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(3, 60))), g) for d in range(240) for g in [r.choice(list(parts))]]
    rows += [(900, None, "en"), (901, "", "de"), (902, "123 !!", "en"), (903, "THE AND" + "x" * 200, None), (904, "the " * 30000 + "ing" * 3000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r["language"] for r in language.identify(docs, language.train(docs)).collect()}
    assert np.mean([out[d]["lang_pred"] == g for d, _, g in rows[:240] if zlib.crc32(str(d).encode()) % 4 == 2]) > 0.97
    assert all(out[d]["lang_pred"] == "und" for d in (900, 901, 902)) and out[903]["lang_pred"] == "en"
    assert out[904]["lang_pred"] == "en" and all(0 <= x["score"] <= 1 for x in out.values())
    clash = language.identify(docs.withColumn("language", docs["lang"]).withColumn("score", docs["doc_id"]), language.train(docs))
    assert clash.columns == ["doc_id", "text", "lang", "language", "score"] and clash.where("language.lang_pred = 'und'").count() == 3
    assert language.identify(docs.where("false"), language.train(docs)).count() == 0
    nothing = docs.withColumn("lang", docs["lang"].substr(99, 1)).where("false")
    assert language.train(nothing) is None and language.identify(docs, None).first()["language"]["lang_pred"] == "und"


# --- op6 ------------------------------------------------------------------------------------


def test_packing_is_whole_and_tight(spark):
    rows, docs = _documents(spark)
    long = [(500, "word " * 3000, "en", "s", 0.0, 0), (501, "a b " * 512, "en", "s", 0.0, 0)]
    docs = docs.unionByName(spark.createDataFrame(long, DOCS))
    out = packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json")).collect()
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = sorted((str(d), np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for d, t, *_ in [*rows, *long] if d != 2)  # 2 comes twice
    docs_back, places = {}, {}
    for r in out:
        assert len(r["ids"]) == 4 * r["length"] and (r["length"] == 1024 or r["piece"] == 0)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs_back.setdefault(str(r["doc_id"]), []).append((r["piece"], r["start"], bytes(r["ids"])))
    for runs in places.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted((d, b"".join(x[2] for x in sorted(xs))) for d, xs in docs_back.items() if d != "2") == want
    assert packing.pack_documents(_empty(spark), tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_solver_against_bounds():
    rng = np.random.default_rng(4)
    for lengths in (rng.integers(1, 1024, 5000), rng.integers(1, 90, 3000), np.full(100, 700), np.array([512, 512, 256, 256, 512]), np.array([1000, 10, 8, 6])):
        histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
        patterns = packing.solve(histogram)
        used = {}
        for pattern, times in patterns:
            assert sum(pattern) <= 1024 and times > 0
            for x in pattern:
                used[x] = used.get(x, 0) + times
        assert used == histogram
        large = int((lengths > 512).sum())
        assert sum(t for _, t in patterns) <= 1.03 * max(-(-int(lengths.sum()) // 1024), large) + 1


def test_solver_against_every_packing():
    from functools import cache

    def fewest(pieces, capacity):
        @cache
        def rest(left, room):  # sequences besides the one with `room`
            return min((rest(tuple(x for k, x in enumerate(left) if k != i), room - p) if p <= room else 1 + rest(tuple(x for k, x in enumerate(left) if k != i), capacity - p) for i, p in enumerate(left)), default=0)

        return rest(tuple(sorted(pieces)), 0)

    r, more = random.Random(5), 0
    for _ in range(150):
        capacity = r.choice([10, 16, 24])
        pieces = [r.randrange(1, capacity + 1) for _ in range(r.randrange(1, 8))]
        patterns = packing.solve(dict(Counter(pieces)), capacity)
        assert sorted(x for p, times in patterns for x in p * times) == sorted(pieces) and all(sum(p) <= capacity for p, _ in patterns)
        more += sum(times for _, times in patterns) - fewest(pieces, capacity)
    assert 0 <= more <= 3


def test_complements():
    index = packing.Complements({5: 1, 3: 2, 2: 1}, 10)
    want = lambda: [sum(1 for i, x in enumerate(left) for y in left[:i] if x + y == s and (x, y) not in left[:0]) for s in range(21)]
    left = [5, 3, 3, 2]
    assert [int(n > 0) for n in index.pairs] == [int(n > 0) for n in want()]
    assert index.pair(6) == (3, 3) and index.pair(5) == (3, 2) and index.pair(4) is None
    assert index.exact(np.array([7, 8, 9]), 5) == (7, (2,)) and index.exact(np.array([11]), 5) == (11, (3, 3)) and index.exact(np.array([5, 7]), 5) == (5, ())
    assert index.exact(np.array([9]), 5) is None
    index.change(3, -1)
    left = [5, 3, 2]
    assert index.pairs.tolist() == want() and index.pair(6) is None
    index.change(5, -1)
    left = [3, 2]
    assert index.pairs.tolist() == want()


# --- op7 ------------------------------------------------------------------------------------


def _links(rows):
    units = []
    for vec_id, v, label in rows:
        ok = vec_id is not None and label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
        units.append(np.array(v) / np.linalg.norm(v) if ok else None)
    n, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and a @ b >= 0.93:
                n[i] += 1
                n[j] += 1
                parent[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        low[root(i)] = min(low.get(root(i), 1 << 60), r[0])
    return sorted((r[0], n[i], low[root(i)], r[0] == low[root(i)]) for i, r in enumerate(rows))


@pytest.mark.parametrize("cell", [1024, 16])
def test_vectors_equal_brute_force(spark, cell):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 16))
    rows = []
    for i in range(300):
        v = base[rng.integers(30)] + rng.normal(scale=rng.choice([0.05, 0.2, 1.0]), size=16)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    rows += [(300 + i, rows[0][1], rows[0][2]) for i in range(40)]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, rows[0][1][:8]]
    rows += [(400 + i, v, 0) for i, v in enumerate(odd)] + [(420, rows[0][1], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    out = sorted(tuple(r) for r in vectors.near_duplicates(df.withColumn("copies", df["label"]), cell=cell).collect())
    want = _links(rows)
    assert len(out) == len(want) and sum(a == b for a, b in zip(out, want, strict=True)) >= 0.98 * len(want)
    assert vectors.near_duplicates(df.where("false")).count() == 0


def test_recall_plan():
    assert vectors.plan(100) == (0, 1)
    signs, tables = vectors.plan(1_000_000)
    assert signs == 11 and 1 - (1 - (1 - np.arccos(0.93) / np.pi) ** signs) ** tables >= 0.9995
    assert 0 < vectors.least_collisions() < vectors.PROJECTIONS


@pytest.mark.parametrize(("n", "m"), [(5, 7), (90, 131), (200, 64)])
def test_collisions_are_counted_in_windows(n, m):
    rng = np.random.default_rng(8)
    a, b = rng.integers(60, 196, (n, 32), np.uint8), rng.integers(60, 196, (m, 32), np.uint8)
    counts = (np.abs(a[:, None].astype(int) - b[None].astype(int)) <= round(vectors.WINDOW * vectors.STEPS)).sum(2)
    for needed in (0, 1, 9, 12, 25, 32, 33):
        assert (vectors.colliding(a, b, needed) == (counts >= needed)).all()


def test_many_vectors_of_one_label(spark):
    """Several tables, dense buckets cut into blocks, recall just at the threshold."""
    import pandas as pd

    rng = np.random.default_rng(11)
    n, dim = 20_500, 24
    base = rng.normal(size=(n, dim))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    for i in range(0, 4000, 2):  # pairs of a cosine from 0.93 to 0.945
        away = rng.normal(size=dim)
        away -= (away @ base[i]) * base[i]
        c = 0.93 + 0.015 * rng.random()
        base[i + 1] = c * base[i] + np.sqrt(1 - c * c) * away / np.linalg.norm(away)
    base[5000:6500] = base[5000] + rng.normal(scale=0.04, size=(1500, dim))  # one crowd
    base = base.astype(np.float32)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": base.astype(float).tolist(), "label": 1}), "vec_id long, embedding array<double>, label int").repartition(4)
    assert vectors.plan(n)[1] > 5
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df).collect()}
    unit = base.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    counts, found, missed = np.zeros(n, np.int64), 0, 0
    parent = np.arange(n)
    for i in range(0, n, 2048):
        x, y = np.nonzero(unit[i : i + 2048] @ unit.T >= 0.93)
        x += i
        x, y = x[x != y], y[x != y]
        counts += np.bincount(x, minlength=n)
        parent = components.merge_labels(parent, x, y)
    links = np.array([got[i]["n_links"] for i in range(n)])
    assert (links <= counts).all() and links.sum() >= 0.999 * counts.sum() and counts.sum() > 1_000_000
    low = links[:4000].sum() / counts[:4000].sum()  # of pairs just at the threshold
    assert low >= 0.997
    assert np.mean([got[i]["component_id"] == parent[i] for i in range(n)]) >= 0.999


# --- op8 ------------------------------------------------------------------------------------


def test_mixing_equals_sql(spark):
    import duckdb

    rows, _ = _documents(spark, 200, 8)
    rows = [r for r in {r[0]: r for r in rows if r[0] is not None}.values()]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted(((r["doc_id"], r["mixed"]["domain"], r["lang"], r["source"], r["mixed"]["n_tokens"], r["mixed"]["n_selected"]) for r in mixing.mix(docs).collect()), key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [r[:4] for r in rows])
    assert got == sorted((tuple(r) for r in con.sql(mixing.ORACLE).fetchall()), key=str)


def test_mixing_edges(spark):
    rows, docs = _documents(spark)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows) and "cut" in out[0].asDict()
    total = sum(r["mixed"]["n_tokens"] for r in out)
    taken = sum(r["mixed"]["n_tokens"] * r["mixed"]["n_selected"] for r in out)
    assert taken <= total // 2 and taken >= total // 2 - 120 * 40
    assert mixing.mix(_empty(spark)).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("web", "en", "a", 10), ("web", "en", "b", 1000), ("books", "en", "c", 1000)], "_mix_domain string, _mix_lang string, _mix_source string, tokens long")
    got = {r["_mix_source"]: r["got"] for r in mixing.leaf_budgets(leaves, (1, 2), 1, {"web": 1, "books": 1}, {"en": 1}).collect()}
    assert got == {"a": 10, "b": 492, "c": 502}


# --- op9 ------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    tricky = r"\### Assistant: </turn> ok"
    rows = [(1, 1, "assistant", "hi"), (1, 0, "user", "a <b> \\ c\n"), (1, 2, "assistant", None), (2, 0, None, "x"), (None, 0, "user", tricky), (3, 0, "assistant", tricky), (3, 0, "assistant", tricky), (4, None, "sys>", "😀")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns.withColumn("part", turns["turn"]))).collect()}
    order = {}
    for c, t, role, text in sorted(rows, key=lambda x: (str(x[0]), x[1] if x[1] is not None else -1, x[2] or "", x[3] or "")):
        order.setdefault(c, []).append((role or "", text or ""))
    assert set(out) == set(order)
    for c, said in order.items():
        loss = "".join(t for r, t in said if r == "assistant")
        assert out[c]["n_turns"] == len(said) and out[c]["loss_chars"] == len(loss)
        assert out[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert out[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.format_conversations(turns.where("false"))).count() == 0


def test_long_conversations_come_in_parts(spark):
    turns = spark.range(400).selectExpr("7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "repeat('word <', 100) as text")
    formatted = chat.format_conversations(turns)
    assert formatted.count() > 1
    row = chat.read_back(formatted).first()
    assert (row["n_turns"], row["loss_chars"]) == (400, 200 * 600)


def test_template_language():
    render = lambda t, **names: "".join(x for x, _ in chat.compile_template(t)(names) if x is not None)
    assert render("a{{ 'b' ~ 1 }}{% if x == 'y' %}1{% elif not x %}2{% else %}3{% endif %}", x="y") == "ab11"
    assert render("{{ m['k'] | upper }}{{ none }}", m={"k": "v"}) == "V"
    assert chat.fold(chat.parse("a{{ 'b' | upper }}{% if true %}c{% else %}{{ x }}{% endif %}{% if false %}d{% endif %}")) == [("text", "aBc")]
    pieces = list(chat.compile_template("{% for m in ms %}{{ m }}{% generation %}!{% endgeneration %}{% endfor %}")({"ms": ["a", "b"]}))
    assert [p for p in pieces if p[0]] == [("a", False), ("!", True), ("b", False), ("!", True)]
    for bad in ("{{ x.__class__ }}", "{{ f() }}", "{% for x %}{% endfor %}", "{% if x %}", "{{ x | what }}", "{% import os %}", "{{ 'a }}", "{{ _x }}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)
    for bad, names in (("{{ x }}", {}), ("{{ x.k }}", {"x": "s"}), ("{{ x }}", {"x": [1]})):
        with pytest.raises(chat.TemplateError):
            render(bad, **names)


# --- op10 -----------------------------------------------------------------------------------


def _fingerprint(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _classes(fps, budget=2):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


@pytest.mark.parametrize("subtree", [None, 4])
def test_simhash_equals_brute_force(spark, subtree):
    rows, docs = _documents(spark, 60)
    r = random.Random(21)
    chain = ["%s tail" % " ".join(f"c{i}" for i in range(300))]  # long texts one word apart, some without an id
    for k in range(8):
        words = chain[-1].split()
        words[r.randrange(300)] = f"n{k}"
        chain.append(" ".join(words))
    rows += [(None if k % 2 else 700 - k, t, "en", "s", 0.0, 0) for k, t in enumerate(chain)]
    rows += [(900, "\n".join(["w"] * 50_000), "en", "s", 0.0, 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit(1)).repartition(3)
    got = sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs, subtree=subtree).collect()), key=str)
    fps = [_fingerprint(r[1]) for r in rows]
    roots = _classes(fps)
    smallest = {}
    for r, k in zip(rows, roots, strict=True):
        if r[0] is not None:
            smallest[k] = min(smallest.get(k, 1 << 62), r[0])
    assert got == sorted(((r[0], f, smallest.get(k)) for r, f, k in zip(rows, fps, roots, strict=True)), key=str)
    assert simhash.near_duplicates(_empty(spark)).count() == 0


@pytest.mark.parametrize(("subtree", "budget", "parts"), [(None, 2, 2), (50, 2, 2), (3, 1, 1), (3, 3, 4), (3, 2, 2)])
def test_trie_join_equals_brute_force(spark, subtree, budget, parts):
    r = random.Random(6)
    fps = {r.getrandbits(64) for _ in range(300)}
    fps |= {(0xABCDE << 44) | r.getrandbits(16) << r.choice([0, 28]) for _ in range(200)}  # a dense prefix
    for f in list(fps)[:80]:
        for _ in range(3):
            f ^= 1 << r.randrange(64)
            fps.add(f ^ (1 << r.randrange(64)))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    leaves = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r["node"]: r["root"] for r in components.connected_components(simhash.trie_links(leaves, budget, subtree, parts)).collect()}
    low = {}
    roots = _classes(fps, budget)
    for f, k in zip(signed, roots, strict=True):
        low[k] = min(low.get(k, f), f)
    assert [got.get(f, f) for f in signed] == [low[k] for k in roots]
    if subtree == 3:
        trees = simhash.cut(leaves, subtree)
        counts = np.bincount(trees.of(np.array(fps, np.uint64)), minlength=len(trees.starts))
        assert len(set(trees.depths.tolist())) > 5 and trees.depths.max() > simhash.COUNTED and counts.sum() == len(fps)


def test_near_subtrees_are_those_within_the_budget():
    r = random.Random(2)
    counts = np.array([r.choice([0, 0, 1, 9]) for _ in range(256)])
    nodes = simhash.split(counts, 12)
    assert all(counts[a : a + (256 >> d)].sum() <= 12 or d == 8 for a, d in nodes)
    trees = simhash.Subtrees([a << 56 for a, _ in nodes], [d for _, d in nodes])
    for bits in (0, 1, 2):
        for k, (a, d) in enumerate(nodes):
            want = [j for j, (b, e) in enumerate(nodes) if ((a ^ b) >> (8 - min(d, e))).bit_count() <= bits]
            assert trees.near(k, bits).tolist() == want


def test_dense_prefixes_are_cut_as_deep_as_it_takes(spark):
    """Leaves that share 40 bits, and few elsewhere: every subtree is small."""
    r = random.Random(6)
    dense = {0xABCDEF1234 << 24 | r.randrange(1 << 24) for _ in range(5000)}
    signed = np.array(sorted(dense | {r.randrange(1 << 64) for _ in range(500)}), np.uint64).view(np.int64)
    leaves = spark.createDataFrame([(int(f),) for f in signed], "fp long")
    trees = simhash.cut(leaves, 100)
    held = np.bincount(trees.of(signed.view(np.uint64)), minlength=len(trees.starts))
    assert held.sum() == len(signed) and held.max() <= 100 and trees.depths.max() > 40
    assert (np.diff(trees.starts.astype(object)) > 0).all() and trees.starts[0] == 0


def test_similar_sets_are_found_by_their_rarest_members():
    """Against all pairs, for links that may be forbidden, small chunks, and groups of equal fingerprints and unlike texts."""
    r, before = random.Random(3), simhash.PAIRS
    try:
        for _ in range(150):
            base = [r.sample(range(60), r.randrange(0, 25)) for _ in range(4)]
            sets = []
            for _ in range(r.randrange(0, 30)):
                mine = set(r.choice(base)) ^ {r.randrange(80) for _ in range(r.randrange(0, 4))}
                sets.append(np.array(sorted(mine), np.uint64))
            odd, least, simhash.PAIRS = r.random() < 0.5, r.choice([0.5, 0.8, 0.9]), r.choice([1, 5, 1000])
            allowed = lambda x, y, odd=odd: (x + y) % 3 != 1 if odd else np.ones(len(x), bool)
            want = list(range(len(sets)))
            for x in range(len(sets)):
                for y in range(x):
                    common = len(set(sets[x].tolist()) & set(sets[y].tolist()))
                    if common and common >= least * (len(sets[x]) + len(sets[y]) - common) and allowed(np.array([x]), np.array([y]))[0] and want[x] != want[y]:
                        low, high = sorted((want[x], want[y]))
                        want = [low if p == high else p for p in want]
            assert simhash.similar_pairs(sets, allowed, least).roots().tolist() == want
    finally:
        simhash.PAIRS = before
    rng = np.random.default_rng(0)
    common = rng.integers(0, 1 << 62, 80).astype(np.uint64)
    for own, parts in ((25, 20_000), (5, 1)):
        sets = [np.unique(np.concatenate((common, rng.integers(0, 1 << 62, own).astype(np.uint64)))) for _ in range(20_000)]
        assert len(set(simhash.similar_pairs(sets, lambda x, y: np.ones(len(x), bool)).roots().tolist())) == parts


def _similarity(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} for w in (t.lower().split() for t in (a, b)))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize(("subtree", "block"), [(None, simhash.BLOCK), (20, simhash.BLOCK), (20, 700)])
def test_similar_documents_equal_brute_force(spark, subtree, block):
    import corpus_pipeline

    r = random.Random(12)
    rows = []
    for d in range(40):
        words = [f"w{r.randrange(500)}" for _ in range(r.randrange(30, 400))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(3):
            near = list(words)
            for _ in range(r.randrange(1, 4)):
                near[r.randrange(len(near))] = "new"
            rows.append((len(rows), " ".join(near)))
    same = "x " * 400  # nearly all shingles are equal, and so are fingerprints, but not the sets
    rows += [(len(rows) + k, same + " ".join(f"{k}y{i}" for i in range(30))) for k in range(3)]
    rows += [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, rows[0][1].upper())]
    fps = [simhash.several(t) for _, t in rows]
    assert [f[0] for f in fps] == [simhash.fingerprint(t, simhash.SHORT) for _, t in rows] and len({*fps[0]}) == simhash.TABLES
    near = lambda a, b: min((x ^ y).bit_count() for x, y in zip(a, b, strict=True)) <= simhash.WIDE
    parent = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if near(fps[i], fps[j]) and _similarity(rows[i][1] or "", rows[j][1] or "") >= 0.8 and parent[i] != parent[j]:
                low, high = sorted((parent[i], parent[j]))
                parent = [low if p == high else p for p in parent]
    assert near(fps[160], fps[161]) and parent[160:163] == [160, 161, 162]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = dict(simhash.similar_documents(docs, subtree=subtree, block=block).collect())
    assert [got[i] for i in range(len(rows))] == parent
    old = {x["component_id"] for x in simhash.near_duplicates(docs).collect()}
    kept = {x["doc_id"] for x in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()}
    assert kept == set(parent) and len([d for d in old if d not in kept]) > 20
    assert simhash.similar_documents(docs.where("false")).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, **{i: 100 for i in range(101, 160)}, 201: 200}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline

    data = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    near = corpus_pipeline.near_dedup_stage(spark, documents, data)
    # the stage's contract: five words, similarity 0.8 or more (here no pair of the table is missed)
    parent = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if parent[i] != parent[j] and _similarity(a or "", b or "") >= 0.8:
                low, high = sorted((parent[i], parent[j]))
                parent = [low if p == high else p for p in parent]
    first = {}
    for (d, _), k in zip(rows, parent, strict=True):
        first[k] = min(first.get(k, 1 << 60), d)
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(first.values()) and near.columns == documents.columns
    cut = {r["doc_id"]: r for r in corpus_pipeline.substring_stage(spark, documents, data).collect()}
    for d, n, removed, kept in _cut(rows):
        assert (d in cut) == (removed < n or n == 0)
        if d in cut:
            assert cut[d]["text"] == (kept if removed else dict(rows)[d]) and cut[d]["n_chars"] == len(cut[d]["text"])
    repeated = documents.unionByName(documents.limit(3))
    assert corpus_pipeline.near_dedup_stage(spark, repeated, data).count() == len(first)
    folder, setting = common.shared_dir(spark).removeprefix("file://"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, "777")
    before = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, data)
    assert [n.split("-")[0] for n in set(os.listdir(folder)) - before] == ["packing"] and spark.conf.get(setting) == "777"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "substring_dedup", "mixing", "packing"]
    assert out.count() > 0 and out.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_pipeline_mixing_and_packing(spark):
    import corpus_pipeline
    import duckdb

    data = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{data}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    share = f"* {mixing.SHARE[0]} // {mixing.SHARE[1]}"
    assert share in mixing.ORACLE
    want = {d: n for d, *_, n in con.sql("SELECT doc_id, n_selected FROM (" + mixing.ORACLE.replace(share, "* %d // %d" % corpus_pipeline.MIX_SHARE) + ")").fetchall() if n}
    mixed = corpus_pipeline.mixing_stage(spark, documents, data)
    got = Counter(r["doc_id"] for r in mixed.collect())
    assert got == want and mixed.columns == documents.columns and max(got.values()) > 1
    packed = corpus_pipeline.packing_stage(spark, mixed, data).collect()
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    sizes = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in documents.collect() if r["doc_id"] in got}
    whole = Counter()
    for r in packed:
        whole[r["doc_id"]] += r["length"]
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    assert whole == {d: sizes[d] * n for d, n in got.items()}


def test_pipeline_of_odd_documents(spark, tmp_path):
    import corpus_pipeline

    schema = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").schema
    odd = [(None, "no id here", "en", "src1", 10), (None, "no id here", "en", "src1", 10), (5, None, None, None, None), (6, "", "de", "src2", 0), (7, "word " * 60_000, "en", "src3", 300_000), (8, "word " * 60_000, "en", "src3", 300_000), (8, "other text", "en", "src3", 10)]
    labels = spark.createDataFrame([(7, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema).withColumn("fp", F.lit(1)).withColumn("_id", F.lit("x"))
        for name, stage in corpus_pipeline.STAGES:
            docs = common.materialize(stage(spark, docs, str(tmp_path)), f"odd_{name}")
            if name == "near_dedup":
                kept = [r["doc_id"] for r in docs.collect()]
                assert not rows or kept.count(None) == 2 and kept.count(8) == 0
        assert {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(docs.columns) and (docs.count() == 0) == (not rows)


def test_extra_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e")], "doc_id long, text string")
    for name in ("part", "ids", "start", "length", "rank", "missing", "fp", "rep", "node", "content", "table", "n_ids"):
        docs = docs.withColumn(name, F.lit("x"))
    assert huffman.huffman_round_trip(docs, tokenizer_path("word_bpe_49k.json")).count() == 2
    assert packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json")).count() == 2
    assert simhash.near_duplicates(docs).count() == simhash.similar_documents(docs).count() == 2


@pytest.mark.parametrize("name", ["op3_substring_dedup", "op7_collision_counting", "op8_hierarchical_mixing", "op9_chat_templates"])
def test_query_equals_sql(spark, name):
    import duckdb

    from staygrid.llm import queries

    data, con = "/root/testdata/sf0.001", duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    df = queries.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    want = con.sql(queries.ORACLE_SQL[name])
    at = [list(want.columns).index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = [f"op{i}_" for i in range(1, 11)] + ["pipeline"]
    assert all(any(q.startswith(n) for q in entry.queries()) for n in names)
