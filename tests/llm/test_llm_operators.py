"""Each operator against a plain version of itself, odd rows and empty tables included."""

import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_prose import prose
from matchlens.llm import (bytebpe, exact, packing, pii, quality, sentencepiece_codec, setsketch,
                           substring, suffix, tokens, topk)
from matchlens.llm.columns import pieces_by_bytes

BLANKS = " \t\n\x0b\x0c\r"


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def words_of(text):
    for blank in BLANKS[1:]:
        text = (text or "").replace(blank, " ")
    return [w for w in (text or "").split(" ") if w]


# --- token counts and packing

def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


ODD_TEXTS = ["", " ", "  a  b   c ", "a\n b", "tab\t x\t\ty  ", "<|endoftext|> a<|endoftext|>b",
             "Σας ΣΑΣ É é", " ̈a", "日本語 テキスト", "a\x00b\x1c c", "a \x1cb", "x" * 300,
             "it's we'll DON'T", "12 345 6.7. Next", "   a", "a  b  c"]


def test_byte_ids_are_those_of_the_library():
    plain, mine = library("byte_bpe_50k.json"), bytebpe.ByteBpe(
        public_tokenizers.path("byte_bpe_50k.json"))
    for text in ODD_TEXTS:
        assert mine.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_token_counts(spark, odd_docs, odd_rows, no_docs):
    plain = library("word_bpe_49k.json")
    count = lambda t: len(plain.encode(t, add_special_tokens=False).ids)
    path = public_tokenizers.path("word_bpe_49k.json")
    assert tokens.count_batch([t.encode() for t in ODD_TEXTS], path) == [
        count(t) for t in ODD_TEXTS]
    expected = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 2048)
                for i, t in odd_rows]
    assert rows_of(tokens.count_tokens(odd_docs)) == sorted(expected, key=repr)
    assert tokens.count_tokens(no_docs).count() == 0


def test_safe_pieces_join_to_the_text():
    text = b"ab cd\tef " * 50 + b"z" * 40
    pieces = list(tokens.safe_pieces(text, 16))
    assert b"".join(pieces) == text
    assert all(p[0] in b" \t" for p in pieces[1:])


def test_counts_with_a_sentencepiece_model(odd_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = {r["n_bytes"]: r["n_tokens"] for r in tokens.count_tokens(odd_docs, path).collect()}
    assert found[0] == 0 and found[3] >= 1


def test_packing_keeps_every_id_once(odd_docs, odd_rows, no_docs):
    plain = library("byte_bpe_50k.json")
    pieces = packing.pack(odd_docs.coalesce(1)).collect()
    ids = {}
    for row, (_, text) in enumerate(odd_rows):
        ids[row] = plain.encode(text or "", add_special_tokens=False).ids + [1]
    line = [x for row in range(len(odd_rows)) for x in ids[row]]  # order is preserved
    pieces.sort(key=lambda r: (r["sequence_id"], r["offset"]))
    assert [x for r in pieces for x in r["ids"]] == line
    sequences = {}
    for r in pieces:
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sequences.values()) <= 2048
    assert sum(map(packing.padding, sequences.values())) < 0.02 * len(line) + 64
    assert packing.pack(no_docs).count() == 0


def test_cuts_are_the_cheapest():
    draw = np.random.default_rng(3)
    for _ in range(40):
        total = int(draw.integers(5, 60))
        inner = np.flatnonzero(draw.random(total) < 0.4)
        positions = np.unique(np.append(inner[inner > 0], total))
        positions = np.union1d(positions, np.arange(8, total, 8))
        fees = draw.choice([0.0, 3.0, 7.0], len(positions))
        best = {0: 0.0}
        for p, fee in zip(positions.tolist(), fees):
            best[p] = fee + min(best[q] + packing.padding(p - q, 16) for q in best if p - q <= 16)
        cuts = packing.best_cuts(positions, fees, 16)
        fee_of, at, cost = dict(zip(positions.tolist(), fees)), 0, 0.0
        for cut in cuts:
            cost, at = cost + fee_of[cut] + packing.padding(cut - at, 16), cut
        assert cost == pytest.approx(best[total])


# --- piece codec

def viterbi_score(model, word):
    """Best score of a string, by trying every piece at every place."""
    text = word.encode()
    pieces = {}
    for i, surface in enumerate(model.surface):
        if i not in model.byte_of and i > 2:
            pieces[surface.replace(b" ", "▁".encode())] = i
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 48), end):
            i = pieces.get(text[start:end])
            if i is not None:
                best[end] = max(best[end], best[start] + model.score[i])
    return best[-1]


@pytest.fixture(scope="module")
def model():
    return sentencepiece_codec.Unigram(public_tokenizers.path("piece_bpe_32k.model"))


def test_paths_are_the_best(model):
    for word in ("▁the", "▁theantes", "▁Thonthsh", "▁ererbe,", "▁a", "▁schule", "▁12345"):
        ids = np.frombuffer(model.solve_many([word.encode()])[0], "<i4")
        assert ids.tolist() == model.solve(word.encode())
        assert sum(model.score[ids]) == viterbi_score(model, word)


def test_unknown_characters_become_bytes(model):
    ids = model.encode_batch(["\U0001F9FF"])[0].tolist()
    assert ids[-4:] == [3 + b for b in "\U0001F9FF".encode()]


def test_round_trip(model, odd_docs, odd_rows, no_docs):
    found = sentencepiece_codec.round_trip(odd_docs).collect()
    assert sorted((r["doc_id"] or 0, r["lossless"]) for r in found) == sorted(
        (i or 0, "▁" not in (t or "")) for i, t in odd_rows)
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(odd_docs))
    assert rows_of(back) == sorted(
        ((i, (t or "").replace("▁", " ")) for i, t in odd_rows), key=repr)
    assert sentencepiece_codec.digests(no_docs).count() == 0
    assert [model.decode(x) for x in model.encode_batch(ODD_TEXTS)] == ODD_TEXTS


# --- exact duplicates

def test_directory_doubles_until_buckets_fit():
    counts = np.zeros(1 << 16, np.int64)
    counts[:4] = 10
    counts[1 << 15] = 30
    directory = exact.grow_directory(counts, 25)
    held = np.bincount(directory, counts)
    assert (held[held > 25] == 30).all() and len(directory) == 1 << 16
    assert (np.diff(directory) >= 0).all()


def test_exact_groups(odd_docs, odd_rows, no_docs):
    found = exact.exact_groups(odd_docs, bucket_keys=1).drop("text_key")
    groups = {}
    for i, t in odd_rows:
        groups.setdefault(t or "", []).append(i)
    expected = []
    for i, t in odd_rows:
        keep = max((x for x in groups[t or ""] if x is not None), default=None)
        expected.append((i, keep, len(groups[t or ""]), i == keep,
                         hashlib.sha256((t or "").encode()).hexdigest()))
    assert rows_of(found) == sorted(expected, key=repr)
    by_bytes = exact.exact_groups(odd_docs, bucket_bytes=64).drop("text_key")
    assert rows_of(by_bytes) == rows_of(found)
    assert exact.exact_groups(no_docs).count() == 0
    kept = exact.without_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(e[3] for e in expected)


def test_owner_separates_texts_that_share_a_key():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * 3, pa.int32()), pa.array([7] * 3, pa.int64()),
         pa.array([b"a", b"b", b"a"], pa.binary()), pa.array([1, 1, 2], pa.int64()),
         pa.array([1, 2, None], pa.int64())], names=["bucket", "key", "text", "n", "max_id"])
    out = next(exact._own(iter([batch]))).to_pylist()
    assert [(r["chain"], r["n"], r["keep_id"]) for r in out] == [(0, 3, 1), (1, 1, 2)]


# --- near duplicates

def shingles(text, size):
    words = words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + size]) for k in range(len(words) - size + 1)}


def near_by_force(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= percent * len(sets[a] | sets[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[k]]
        least = min((x for x in ids if x is not None), default=None) if sets[k] else i
        out.append((i, len(sets[k]), least, i == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_groups(spark, odd_docs, odd_rows, no_docs, size, percent):
    base = prose(50, 120).split(" ")
    rows = list(odd_rows)
    for k in range(40):  # a drifting family: neighbours are linked, the ends are not
        base[(7 * k) % 120] = f"w{k}"
        rows.append((100 + k, " ".join(base)))
    more = odd_docs.sparkSession.createDataFrame(rows[len(odd_rows):], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(more)
    found = setsketch.near_groups(docs, shingle=size, percent=percent).drop("text_key")
    assert rows_of(found) == near_by_force(rows, size, percent)


def test_open_buckets_are_compared_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "CHUNK_NODES", 4)
    base, rows = prose(51, 60).split(" "), []
    for k in range(24):  # one template: each row is linked with the next in its pair only
        own = base[:50] + [f"v{k // 2}x{j}" for j in range(8)] + [f"end{k % 2}"]
        rows.append((k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = setsketch.near_groups(docs, shingle=3, percent=85).drop("text_key")
    assert rows_of(found) == near_by_force(rows, 3, 85)
    assert len({r[2] for r in rows_of(found)}) == 12


@pytest.mark.parametrize("nodes,cap", [(5, 2), (40, 3), (40, 1500)])
def test_chunked_links_join_what_all_pairs_join(spark, monkeypatch, nodes, cap):
    monkeypatch.setattr(setsketch, "CHUNK_NODES", cap)
    base, rows = prose(52, 80).split(" "), []
    for k in range(nodes):
        rows.append((k, " ".join(base[:60] + [f"u{k % 5}x{j}" for j in range(12)] + [f"z{k}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = setsketch.signatures(docs, "doc_id", "text", 3)
    nodes_of = setsketch.stored(signed.selectExpr(
        "doc_id as node", "doc_id as class_id", "text_key as class_key", "n_shingles"), "nodes")
    some = nodes_of.selectExpr("cast(7 as long) as bucket", "node", "node as component")
    links = setsketch._block_links(docs, some, nodes_of, "doc_id", "text", 3, 85)
    labels = {} if links.isEmpty() else {
        r["node"]: r["component"] for r in setsketch.components(links).collect()}
    assert [(i, labels.get(i, i)) for i, _ in rows] == [
        (i, least) for i, _, least, _ in sorted(near_by_force(rows, 3, 85))]


def test_near_groups_of_nothing(odd_docs, no_docs):
    assert setsketch.near_groups(no_docs).count() == 0
    assert setsketch.without_near_copies(odd_docs).columns == odd_docs.columns


def test_sketches_merge_and_estimate():
    draw = np.random.default_rng(5)
    pool = draw.integers(0, 2 ** 63, 3000).astype(np.uint64)
    one, two = pool[:2000], pool[200:2200]
    a, b, union = setsketch.sketch([one, two, pool[:2200]])
    assert (np.maximum(a, b) == union).all()
    found = setsketch.estimate(a[None], b[None], np.array([2000.0]), np.array([2000.0]))[0]
    assert abs(found - 1800 / 2200) < 0.15


def test_bands_reach_the_threshold():
    for t in (0.8, 0.85):
        rows = setsketch.band_rows(t)
        assert (1 - t ** rows) ** (setsketch.REGISTERS // rows) <= 1e-6


@pytest.mark.parametrize("stage", [exact.without_copies, setsketch.without_near_copies])
def test_one_row_of_repeated_rows_stays(spark, stage):
    text, other = prose(5, 60), prose(6, 60)
    rows = [(1, text)] * 3 + [(None, other)] * 3 + [(2, "")] + [(2, None), (3, "alone")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)],
                                 "doc_id long, text string, k int")
    left = stage(docs)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"] or "") for r in left.collect()), key=repr) == sorted(
        [(1, text), (None, other), (2, ""), (3, "alone")], key=repr)


# --- repeated passages

def test_substring_removal(odd_docs, odd_rows, no_docs):
    found = substring.remove_repeats(odd_docs)
    first, expected = {}, []
    for i, t in odd_rows:
        words = words_of(t)
        for k in range(len(words) - 12):
            if i is not None:
                w = tuple(words[k:k + 13])
                first[w] = min(first.get(w, i), i)
    for i, t in odd_rows:
        words, gone = words_of(t), set()
        for k in range(len(words) - 12):
            if i is not None and first[tuple(words[k:k + 13])] < i:
                gone |= set(range(k, k + 13))
        expected.append((i, len(words), len(gone),
                         " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert rows_of(found) == sorted(expected, key=repr)
    assert substring.digests(no_docs).count() == 0


def bytes_by_force(rows, window):
    first, out = {}, {}
    for i, t in sorted({r for r in rows if r[0] is not None}, key=lambda r: r[0]):
        text = (t or "").encode()
        gone = np.zeros(len(text) + 1, bool)
        for k in range(len(text) - window + 1):
            w = text[k:k + window]
            if first.setdefault(w, (i, k)) != (i, k):
                gone[k:k + window] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[i, t] = (i, len(text), len(text) - len(kept), spans, kept)
    return sorted((out.get((i, t), (i, len((t or "").encode()), 0, 0, (t or "").encode()))
                   for i, t in rows), key=repr)


@pytest.mark.parametrize("hot", [0, 5000])
def test_suffix_removal(spark, odd_docs, odd_rows, no_docs, hot, monkeypatch):
    monkeypatch.setattr(suffix, "HOT_HEADS", hot)
    rows = [r for r in odd_rows if r[0] != 13] + [
        (20, "line of text that repeats itself here.\n" * 12), (21, "ab" * 300),
        (22, odd_rows[5][1][7:] + odd_rows[9][1][100:900])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in suffix.remove_repeats(docs).collect()]
    found = sorted(((i, n, r, s, bytes(k)) for i, n, r, s, k in found), key=repr)
    assert found == bytes_by_force(rows, 100)
    assert suffix.digests(no_docs).count() == 0
    assert suffix.digests(odd_docs).count() == len(odd_rows)


@pytest.mark.parametrize("hot", [0, 5000])
def test_anchors_over_the_limit_go_window_by_window(spark, odd_rows, hot, monkeypatch):
    monkeypatch.setattr(suffix, "HOT_HEADS", hot)
    tables, single, stored = {}, [], suffix.stored
    windows = suffix._single_windows
    monkeypatch.setattr(suffix, "stored", lambda frame, name: tables.setdefault(
        name, stored(frame, name)))
    monkeypatch.setattr(suffix, "_single_windows",
                        lambda window: single.append(window) or windows(window))
    long = odd_rows[8][1]
    rows = [(k, long[1000 * k:1000 * k + 3000] + f" end {k}") for k in range(6)]
    rows += [(20, "line of text that repeats itself here.\n" * 12), (21, "ab" * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((i, n, r, s, bytes(k)) for i, n, r, s, k in
                    suffix.remove_repeats(docs).collect()), key=repr)
    assert found == bytes_by_force(rows, 100)
    assert tables["suffix-hot"].isEmpty() == (hot > 0) and bool(single) == (hot == 0)


def test_merge_of_transforms_sorts_rotations():
    draw = np.random.default_rng(8)
    for _ in range(10):
        texts = [draw.integers(1, 4, draw.integers(3, 30)).astype(np.uint8) for _ in range(9)]
        parts, orders, base = [], [], 0
        for a in range(0, 9, 3):
            some = [np.append(t, np.uint8(0)) for t in texts[a:a + 3]]
            starts = np.cumsum([0] + [len(t) for t in some[:-1]])
            order, two = suffix.shard_transform(np.concatenate(some), starts, 20)
            parts.append(two)
            orders.append(order + base)
            base += sum(map(len, some))
        shard = suffix.merge(parts, 20)
        merged = np.empty(base, np.int64)
        merged[np.argsort(shard, kind="stable")] = np.concatenate(orders)
        rings = [np.append(t, np.uint8(0)).tobytes() for t in texts]
        rotations = [(r[k:] + r[:k]) * 20 for r in rings for k in range(len(r))]
        seen = [rotations[p][:20] for p in merged]
        assert seen == sorted(seen)


# --- personal data

def test_base_spans():
    text = "a@b.c@d.e 1.2.3.256 010.2.3.4, 4111 1111 1111 1111 +12 34-56 78 90 x@y"
    assert pii.base_spans(text) == [("email", 0, 5), ("ip", 20, 29), ("card", 31, 50),
                                    ("phone", 51, 66)]
    # What a failing match has taken is not tried again.
    assert pii.base_spans("4 4111 1111 1111 1111") == []
    assert pii.base_spans("c_d@e.fg.a@h.i") == [("email", 0, 10)]
    assert pii.base_spans("c@e.fg_a@h.i") == [("email", 0, 6), ("email", 6, 12)]
    assert pii.base_spans("1.2.3.4.5.6.7.8.9") == [("ip", 0, 7), ("ip", 8, 15)]
    assert pii.base_spans("7" * 500_000) == []  # in linear time


# The patterns as they are stated, which the operator finds by other means in linear time.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def valid(kind, match):
        digits = [int(c) for c in match if c in "0123456789"]
        if kind == "ip":
            return all(int(part) <= 255 for part in match.split("."))
        if kind == "phone":
            return 9 <= len(digits) <= 15
        doubled = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
        return kind == "email" or (13 <= len(digits) <= 19
                                   and (sum(doubled) + sum(digits[-1::-2])) % 10 == 0)

    return [(kind, m.start(), m.end()) for kind, pattern in PLAIN.items()
            for m in re.finditer(pattern, text or "") if valid(kind, m[0])]


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def test_base_spans_are_those_of_the_plain_patterns(spark, sf_dir, odd_docs, odd_rows):
    draw = np.random.default_rng(11)
    for length in draw.integers(1, 60, 4000):
        text = "".join(draw.choice(list("@@..++--0123459 ()_%aZé\n"), length))
        assert pii.base_spans(text) == plain_spans(text), text
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for frame in (docs, odd_docs):
        expected = []
        for doc_id, text in frame.select("doc_id", "text").collect():
            spans = plain_spans(text)
            counts = [sum(s[0] == kind for s in spans) for kind in PLAIN]
            expected.append((doc_id, *counts, hashlib.sha256(listed(spans).encode()).hexdigest()))
        found = pii.digests(frame).select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                                          "base_sha256")
        assert rows_of(found) == sorted(expected, key=repr)


def plain_additions(texts):
    """The bootstrapping with dictionaries: per text, what reliable contexts add."""
    forms = {kind: re.compile(form) for kind, form in pii.FORMS.items()}
    seen = [pii.instances(text, pii.base_spans(text)) for text in texts]
    edges, seeds = {}, {}  # pattern -> value -> kind or None
    for one in (i for some in seen for i in some):
        for pattern in one["patterns"]:
            kinds = edges.setdefault(pattern, {})
            kinds[one["value"]] = max(kinds.get(one["value"]) or "", one["kind"] or "") or None
            if kinds[one["value"]]:
                seeds[one["value"], kinds[one["value"]]] = 1.0
    scores, kept = dict(seeds), {}
    for _ in range(pii.ROUNDS):
        kept = {}
        for pattern, values in edges.items():
            for kind in pii.KINDS:
                mine = {v: scores[v, kind] for v in values if (v, kind) in scores}
                like = [v for v, known in values.items() if not known and forms[kind].search(v)]
                open_ones = sum(v not in mine for v in like)
                good = sum(mine.values()) / (len(values) - (1 - pii.UNKNOWN) * open_ones
                                             + pii.SMOOTHING)
                if (good >= pii.MIN_CONFIDENCE
                        and sum(s == 1.0 for s in mine.values()) >= pii.MIN_SEEDS):
                    kept[pattern, kind] = good
        wrong = {}
        for (pattern, kind), good in kept.items():
            for value, known in edges[pattern].items():
                if not known:
                    wrong[value, kind] = wrong.get((value, kind), 1.0) * (1 - good)
        scores = dict(seeds) | {key: min(0.99, 1 - p) for key, p in wrong.items()}
    added = []
    for some in seen:
        best = [(max(((good, kind) for (p, kind), good in kept.items() if p in one["patterns"]),
                     default=None), one) for one in some if one["kind"] is None]
        added.append({(b[1], one["start"], one["end"]) for b, one in best if b})
    return added


def test_added_spans_are_those_of_a_plain_bootstrapping(spark):
    draw = np.random.default_rng(4)
    contexts = ["call me at {} today", "host {} is up", "card no {} expired", "version {} of it",
                "mail to {} please", "ticket {}"]
    texts = []
    for k in range(400):
        digits = "".join(map(str, draw.integers(0, 10, 10)))
        value = [f"+1 {digits[:3]} {digits[3:6]} {digits[6:]}", f"10.0.{k % 250}.{k % 9}",
                 f"user{k}@mail{k % 3}.org", f"{digits[:3]}-{digits[3:6]}-{digits[6:]}",
                 f"v{k % 20}.{k % 7}-rc1", f"user{k}@intranet"][
                     int(draw.choice(6, p=[0.3, 0.15, 0.25, 0.1, 0.1, 0.1]))]
        kind = int(draw.integers(0, 6)) if draw.random() < 0.02 else (
            0 if value[0] == "+" or value.count("-") == 2 else 1 if value[:2] == "10"
            else 4 if "@" in value else 3)
        texts.append(contexts[kind].format(value))
    expected = plain_additions(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.digests(docs).collect()}
    order = {kind: place for place, kind in enumerate(pii.KINDS)}
    for k, text in enumerate(texts):
        spans = set(plain_spans(text)) | expected[k]
        assert found[k] == listed(sorted(spans, key=lambda s: (order[s[0]], s[1], s[2])))
    assert sum(map(len, expected)) > 20


def test_contexts_discover_unseen_identifiers(spark, odd_docs, odd_rows, no_docs):
    rows = [(k, f"client card: {number} paid") for k, number in enumerate(
        ["4111111111111111", "5500000000000004", "340000000000009", "30000000000004",
         "6011000000000004", "3530111333300000", "4012888888881881", "5555555555554444"])]
    rows += [(50, "client card: 4111-XX-1112 paid"), (51, "version 10.4.5-rc1 of it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.digests(docs).collect()}
    assert all(found[k]["n_card"] == 1 for k in range(8))
    assert found[50]["spans"] == "card:13:25" and found[50]["n_card"] == 0
    assert found[51]["spans"] == ""
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert clean[50] == "client card: <CARD> paid" and clean[51] == rows[-1][1]
    spans = {r["doc_id"]: r["spans"] for r in pii.digests(odd_docs).collect()}
    assert spans[12] == "email:5:13"  # phone and card run into each other: too many digits
    assert pii.digests(odd_docs).count() == len(odd_rows)
    assert pii.digests(no_docs).count() == 0
    assert pii.redact(odd_docs).columns == odd_docs.columns


@pytest.mark.parametrize("number, kind", [
    ("(743) 555-3824", "phone"), ("743 555 3824", "phone"), ("743-555 (3824)", "phone"),
    ("743 - 555 - 3824", "phone"), ("4111 1111 1111 1112", "card")])
def test_contexts_discover_numbers_in_groups(spark, number, kind):
    seeds = {"phone": [f"+1 (743) 555-38{k}" for k in range(10, 18)],
             "card": ["4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009",
                      "3000 0000 0000 04", "6011 0000 0000 0004", "3530 1113 3330 0000",
                      "4012 8888 8888 1881", "5555 5555 5555 4444"]}[kind]
    rows = [(k, f"his {kind}: {seed} today") for k, seed in enumerate(seeds)]
    rows.append((50, f"his {kind}: {number} today"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.digests(docs).collect()}
    start = len(f"his {kind}: ")
    assert found[50] == f"{kind}:{start}:{start + len(number)}"
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert clean[50] == f"his {kind}: <{kind.upper()}> today"


def test_unscored_instances_of_the_form_do_not_bury_the_seeds(spark):
    def kept(n_seeds, unseen, pattern="L1 card:"):
        rows = [([pattern], f"seed {k}", "card") for k in range(n_seeds)]
        rows += [([pattern], value, None) for value in unseen]
        seen = spark.createDataFrame(rows, "patterns array<string>, value string, kind string")
        return [(r["pattern"], r["kind"]) for r in pii.reliable_patterns(seen).collect()]

    cards = [f"4111 1111 1111 {k}" for k in range(1112, 1120)]
    assert kept(8, cards[:4]) == [("L1 card:", "card")]  # 8 of 12: a third is unseen
    assert kept(8, cards) == []  # half of them are
    assert kept(8, [f"v1.{k}-beta" for k in range(4)]) == []  # nothing like a card
    assert kept(8, [f"+1 743 555 38{k}" for k in range(10, 14)]) == []  # of another form
    assert kept(4, []) == [("L1 card:", "card")] and kept(3, []) == []


def test_groups_of_a_number_are_one_instance():
    def values(text):
        return [text[i["start"]:i["end"]] for i in pii.instances(text, pii.base_spans(text))]

    assert values("tel (743) 555-3824, 743 555 3825. 12345 it") == [
        "(743) 555-3824", "743 555 3825", "12345"]
    assert values("in (743 555 3824) 2nd A743 555-3824") == ["743 555 3824", "555-3824"]
    assert values("1234 123456 " + "1234 " * 9) == ["123456"]  # more digits than a number has
    assert values("1 2 3 x") == ["1 2 3"] and values("1\n2345\n6") == []


# --- quality

def test_statistics_of_odd_texts(odd_docs, odd_rows):
    found = quality.batch_statistics([b"", b"A b! $$ \n\n", b"  "])
    assert all(np.isfinite(v).all() for v in found.values())
    assert found["log_words"].tolist() == [0.0, np.log1p(3), 0.0]
    assert found["lone_symbols"][1] == 0.0 and found["symbol_words"][1] == 2 / 3


def test_classifier_on_held_out_labels(spark, sf_dir, odd_docs, odd_rows, no_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    out = quality.scored(docs, labels).collect()
    assert len(out) == docs.count()
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in out if r["held_out"] and r["doc_id"] in known]
    assert np.mean([r["predicted"] == known[r["doc_id"]] for r in held]) > 0.85
    odd = quality.scored(odd_docs, labels.limit(0)).collect()
    assert len(odd) == len(odd_rows) and {r["score"] for r in odd} == {0.5}
    assert quality.scored(no_docs, labels).count() == 0
    assert quality.accepted(odd_docs, labels.limit(0), threshold=0.4).columns == odd_docs.columns


def test_score_is_that_of_the_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(quality.training_rows(docs, labels))
    assert model.weights
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    expected = {}
    for doc_id, text in texts.items():
        values = {name: v[0] for name, v in quality.batch_statistics([text]).items()}
        total = model.intercept + sum(
            weight for rule, weight in model.weights
            if all(low < values[name] <= high for name, low, high in rule.bounds))
        expected[doc_id] = 1 / (1 + np.exp(-total))
    for r in quality.scored(docs, labels).collect():
        assert r["score"] == pytest.approx(expected[r["doc_id"]], abs=1e-9)
    kept = {r["doc_id"] for r in quality.accepted(docs, labels).collect()}
    assert kept == {k for k, score in expected.items() if score >= quality.THRESHOLD}


# --- search

@pytest.mark.parametrize("per_pass,numbers", [(3, 10 ** 6), (1000, 10 ** 6), (1000, 50)])
def test_top_k(spark, per_pass, numbers, monkeypatch):
    monkeypatch.setattr(topk, "NUMBERS_PER_PASS", numbers)
    draw = np.random.default_rng(11)
    rows = [(k, [float(x) for x in draw.normal(size=24) * (1 + k % 3)]) for k in range(0, 400, 5)]
    rows += [(1, rows[3][1]), (2, rows[3][1]), (2, rows[3][1]), (None, rows[4][1]), (50, None),
             (3, [float("nan")] * 24), (4, [None] * 24), (6, [1.0, 2.0]), (600, [1.0, -2.0]),
             (7, [float("inf")] * 24), (8, []), (650, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = rows_of(topk.top_k(frame, F.col("vec_id") % 50 == 0, per_pass=per_pass))
    whole = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    queries, expected = {}, []
    for i, v in whole:
        if i % 50 == 0:
            queries[i] = min(queries.get(i, v.tolist()), v.tolist())
    for i, v in queries.items():
        scores = sorted((-int(np.dot(v, w)), j) for j, w in whole if j != i and len(w) == len(v))
        expected += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:5])]
    assert got == sorted(expected, key=repr)


def traced_peak(work) -> int:
    """The most bytes that ``work`` holds at once."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_two_chunks_hold_one_rectangle_of_counts():
    draw = np.random.default_rng(6)
    sets = [np.unique(draw.integers(0, 3000, 60)) for _ in range(800)]
    values, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    one, two = np.arange(0, 800, 2), np.arange(1, 800, 2)
    counts = []
    peak = traced_peak(lambda: counts.append(setsketch.common_counts(values, sizes, one, two)))
    held = np.zeros((800, 3000), np.int64)
    held[np.repeat(np.arange(800), sizes), values] = 1
    assert (counts[0] == held[one] @ held[two].T).all()
    assert peak < 16 << 20


def test_tasks_on_texts_hold_little_beside_a_batch():
    texts = [prose(k, 400) for k in range(40)] * 40
    batch = pa.RecordBatch.from_pydict({"text": texts})
    assert batch.nbytes > 2 << 20

    def measure():
        for part in pieces_by_bytes(iter([batch]), quality.BATCH_BYTES):
            quality.batch_statistics(part.column("text").cast(pa.binary()).to_pylist())

    def sketch():
        for part in pieces_by_bytes(iter([batch]), setsketch.BATCH_BYTES):
            setsketch.sketch(setsketch.batch_shingles(
                part.column("text").cast(pa.binary()).to_pylist(), 5))

    assert traced_peak(measure) < 48 << 20
    assert traced_peak(sketch) < 48 << 20
