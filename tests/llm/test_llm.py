"""The operators of eventloom.llm against brute force, round trips and known cases."""

import base64
import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from eventloom.llm import bpe, decontam, hmm, html_main, jaccard, langid, license_scan, line_dedup, mpeg_audio, packing, queries
from eventloom.llm.common import table
from pyspark.sql import functions as F

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, id long, removed string, language string, matches string, _key string, encoded string, h long"


def edge_docs(spark, *texts):
    """Given texts, then a null, an empty, a blank and two repeated ones; clashing columns; a null id."""
    texts = [*texts, None, "", " \n\n ", "same words here", "same words here"]
    rows = [(i, t, "en", "s", len(t or ""), 1, "x", "x", "x", "x", "x", 1) for i, t in enumerate(texts)]
    rows += [rows[-1], (None, "a text without an id", None, None, None, 1, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, EXTRA)


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}


def test_operators_survive_edges_and_empty_tables(spark):
    some = edge_docs(spark, "one two three four five six")
    for df in (some, some.limit(0)):
        bench = spark.createDataFrame([(1, "one two three four five six"), (2, None), (3, "")], "item_id long, text string")
        n = df.count()
        assert decontam.op1_decontaminate(df, bench).count() == (1 if n else 0)
        assert mpeg_audio.op2_mpeg_audio(df).count() == n
        assert bpe.op9_byte_bpe(df).count() == n
        assert langid.op10_language_id(df).count() == n
        assert line_dedup.op8_line_dedup(df).count() == n
        assert jaccard.op5_ngram_jaccard(df).count() == n
        assert hmm.op3_hmm_score(df).count() == n
        assert license_scan.op4_license_scan(df).count() == 0
        assert packing.op6_pack_tokens(df).agg(F.coalesce(F.sum("n_segments"), F.lit(0))).first()[0] == n
        for keep in (line_dedup.keep_lines(df), jaccard.keep_one(df), decontam.keep_clean(df, bench)):
            assert keep.columns == df.columns and keep.count() <= n


# -- byte-level BPE


def reference_encoding():
    import public_tokenizers as p
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(p.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={}), open(p.path("byte_bpe_50k.tiktoken"), "rb").read()


def test_bpe_equals_the_library(spark, sf, docs):
    enc, content = reference_encoding()
    coder = bpe.Codec(content)
    random.seed(3)
    alphabet = "ab sStr'veldm \n\t  12.!é日　\x85😀'''re"
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(3000)]
    texts += ["x'll've", "'re", "  's", "\n's", "''s", "a" * 3000, "ab" * 700 + "!" * 500, " ", ""]
    for size in (1, 2, 5, 257):  # a text in slices has the same words
        for t in texts[:300]:
            assert [i for ws in bpe.word_slices(t, size) for w in ws for i in coder.merge(w.encode())] == enc.encode_ordinary(t)
    long = "".join(texts) * 6
    ((n, a, b),) = coder.digests([long])
    wanted = enc.encode_ordinary(long)
    assert len(long) > bpe.CHUNK and (n, a, b) == (len(wanted), hashlib.sha256(" ".join(map(str, wanted)).encode()).hexdigest(), hashlib.sha256(long.encode()).hexdigest())
    ids, n = coder.encode_texts(texts)
    ends = np.cumsum(n)
    assert [ids[e - k : e].tolist() for e, k in zip(ends, n)] == [enc.encode_ordinary(t) for t in texts]
    got = rows(bpe.op9_byte_bpe(table(spark, sf, "documents")))
    for i, t in docs.items():
        wanted = enc.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(wanted) and got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, wanted)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_offsets(spark):
    r = bpe.encode(spark.createDataFrame([("héllo wörld",)], "text string")).first()["encoded"]
    _, content = reference_encoding()
    coder = bpe.Codec(content)
    assert r["offsets"] == [0, *itertools.accumulate(len(coder.pieces[i]) for i in r["ids"])][:-1]


# -- MPEG audio


def test_mpeg_round_trip_and_damage():
    for payload in (bytes(64), b"a" * 64, bytes(range(256)) * 40, b"\xff\xfa\xe8\xc0" * 400):
        media = mpeg_audio.wrap(payload)
        r = mpeg_audio.parse(media)
        assert r["payload"] == payload and r["payload_ok"] and not r["crc_bad"] and r["table_frames"] == r["frames"]
        assert r["samples"] == 1152 * r["frames"] and r["duration_us"] == r["samples"] * 1_000_000 // 32000
        assert all(mpeg_audio.header(media[o : o + 4]) for o in r["offsets"])
    media = mpeg_audio.wrap(b"z" * 6400)
    at = mpeg_audio.parse(media)["offsets"][2]
    hurt = mpeg_audio.parse(media[:at] + b"gar\xffbage" + media[at:])
    assert hurt["resyncs"] == 1 and hurt["skipped_bytes"] == 8 and hurt["payload_ok"]
    broken = bytearray(media)
    broken[at + 10] ^= 1
    assert mpeg_audio.parse(bytes(broken))["crc_bad"] == 1
    assert mpeg_audio.parse(b"no audio")["frames"] == 0


def test_mpeg_marks_in_payloads():
    for word in (b"TAG", b"ID3", b"Xing", b"VBRI", b"\xff\xfa\xe8\xc0"):
        for n in (256, 3072):
            for at in [*range(min(n, 260)), *range(n - 260, n - len(word) + 1)]:
                payload = bytearray(b"x" * n)
                payload[at : at + len(word)] = word
                payload = bytes(payload[:n])
                r = mpeg_audio.parse(mpeg_audio.wrap(payload))
                assert r["payload"] == payload and r["payload_ok"] and not r["resyncs"] and not r["old_tag"]


def test_mpeg_tags_and_tables():
    media = mpeg_audio.wrap(b"z" * 6400)
    r = mpeg_audio.parse(media + b"TAG" + bytes(125))
    assert r["old_tag"] and r["payload_ok"] and not r["skipped_bytes"] and r["table_bytes"] == 288 + sum(b - a for a, b in zip(r["offsets"], [*r["offsets"][1:], len(media)]))
    assert len(r["table_seek"]) == 100 and r["table_seek"] == sorted(r["table_seek"])
    r = mpeg_audio.parse(b"junk \xff\xfb\x90\xc0 no frame follows this one " + media[media.index(b"\xff\xfb") :])
    assert r["payload"] == b"z" * 6400 and r["resyncs"] == 1
    frame = bytes([0xFF, 0xFB, 0x58, 0xC0]) + bytes(284)
    vbri = bytearray(frame)
    vbri[36:70] = b"VBRI" + (1).to_bytes(2, "big") + bytes(4) + (1152).to_bytes(4, "big") + (4).to_bytes(4, "big") + b"\0\4\0\2\0\2\0\1" + b"\0\x90" * 4
    r = mpeg_audio.parse(bytes(vbri) + frame * 4)
    assert (r["table"], r["table_frames"], r["table_bytes"], r["table_seek"], r["frames"]) == ("VBRI", 4, 1152, [288, 576, 864, 1152], 4)


def bitwise_crc(bits):
    crc = 0xFFFF
    for b in bits:
        crc = ((crc << 1) ^ (0x8005 if (crc >> 15) ^ b else 0)) & 0xFFFF
    return crc


def test_mpeg_crc_of_layers_one_and_two():
    random.seed(12)
    bits_of = lambda data: [x >> 7 - i & 1 for x in data for i in range(8)]
    for layer, mode in itertools.product((1, 2), (0x00, 0x50, 0xC0)):  # stereo, joint from subband 8, mono
        head = bytes([0xFF, 0xFE if layer == 1 else 0xFC, 0x90, mode])
        size = mpeg_audio.header(head).length
        body = bytes(random.randrange(256) for _ in range(size - 6))
        bits, at, chosen = bits_of(body), 0, 0
        kbps = 288 if layer == 1 else 160
        widths = [4] * 32 if layer == 1 else [4] * 11 + [3] * 12 + [2] * (4 if mode != 0xC0 and kbps / 2 <= 80 else 7)
        for sb, w in enumerate(widths):
            shared = mode == 0x50 and sb >= 8
            for _ in range(1 if mode == 0xC0 or shared else 2):
                chosen += 2 * any(bits[at : at + w]) * (2 if shared else 1)
                at += w
        guarded = at + (chosen if layer == 2 else 0)
        crc = bitwise_crc(bits_of(head[2:]) + bits[:guarded])
        good = head + crc.to_bytes(2, "big") + body
        r = mpeg_audio.parse(good * 3)
        assert (r["layer"], r["frames"], r["crc_ok"], r["crc_bad"]) == (layer, 3, 3, 0)
        bad = bytearray(good)
        bad[6] ^= 0x10
        assert mpeg_audio.parse(good + bytes(bad) + good)["crc_bad"] == 1


def test_mpeg_query(spark, sf, docs):
    got = rows(mpeg_audio.op2_mpeg_audio(table(spark, sf, "documents")))
    for i, t in docs.items():
        data = (t or "").encode()
        padded = data + bytes(-len(data) % 64 if data else 64)
        assert (got[i]["n_bytes"], got[i]["payload_bytes"]) == (len(data), len(padded))
        assert got[i]["payload_sha256"] == hashlib.sha256(padded).hexdigest() and got[i]["tail_crc32"] == zlib.crc32(padded[-64:])
        media = mpeg_audio.wrap(padded)
        assert (got[i]["media_bytes"], got[i]["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())


# -- hidden Markov model


def test_forward_and_counts_equal_enumeration():
    rng = np.random.default_rng(0)
    k, m = 3, 4
    start, move, emit = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(m), k).T
    texts = [np.array([1, 2, 0, 3, 1]), np.array([2, 2, 1]), np.array([0])]
    logs = hmm.forward(texts, start, move, emit)
    wanted, emitted, moves = [], np.zeros((m, k)), np.zeros((k, k))
    for t in texts:
        paths = {}
        for path in itertools.product(range(k), repeat=len(t)):
            p = start[path[0]] * emit[t[0], path[0]]
            for a, b, o in zip(path, path[1:], t[1:]):
                p *= move[a, b] * emit[o, b]
            paths[path] = p
        total = sum(paths.values())
        wanted.append(np.log(total))
        for path, p in paths.items():
            for s, o in zip(path, t):
                emitted[o, s] += p / total
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total
    assert np.allclose(logs, wanted)
    for block in (1, 2, 3, 100):
        _, got_moves, got_emitted, total = hmm.expected(texts, start, move, emit, block)
        assert np.allclose(got_moves, moves) and np.allclose(got_emitted, emitted) and np.isclose(total, sum(wanted))


def test_hmm_query(spark, sf, docs):
    got = rows(hmm.op3_hmm_score(table(spark, sf, "documents")))
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in docs.items()}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(w in c for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
    out = [i for i in docs if held[i]]
    assert sum(got[i]["score"] for i in out) > sum(got[i]["base_score"] for i in out)


# -- n-gram Jaccard join


def brute_components(texts):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_jaccard_query(spark, sf, docs):
    got = rows(jaccard.op5_ngram_jaccard(table(spark, sf, "documents")))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_components(docs)


@pytest.mark.parametrize("hot, side", [(8, 256), (2, 16)])
def test_jaccard_groups_with_chains_and_boilerplate(spark, monkeypatch, hot, side):
    monkeypatch.setattr(jaccard, "HOT", hot)  # columns over so many rows never meet in one task
    monkeypatch.setattr(jaccard, "SIDE", side)
    random.seed(5)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(6))
    source, shared, texts = [word() for _ in range(120)], [word() for _ in range(60)], {}
    for i in range(150):  # copies with 0 to 5 words changed: some link to some only
        w = list(source)
        for _ in range(i % 6):
            w[random.randrange(len(w))] = word()
        texts[i] = " ".join(w)
    for i in range(150, 230):  # a long common passage in otherwise different texts
        texts[i] = " ".join([*[word() for _ in range(30)], *shared, *[word() for _ in range(i % 7)]])
    chain = [word() for _ in range(90)]
    for i in range(230, 250):  # neighbours link, ends don't
        texts[i] = " ".join(chain[i - 230 :] + [word() for _ in range(i - 230)])
    texts |= {250: "a b", 251: "A  b", 252: "", 253: None, 254: "a b c d e", 255: "a\tb c d e"}
    order = list(texts)
    random.shuffle(order)
    got = rows(jaccard.op5_ngram_jaccard(spark.createDataFrame([(i, texts[i]) for i in order], "doc_id long, text string").repartition(7)))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_components(texts)


def test_jaccard_takes_other_keys(spark):
    texts = [("b", "one two three four five six"), ("a", "one two three four five six"), ("c", "else where"), (None, "x"), ("d", None)]
    got = {r["id"]: (r["component_id"], r["n_links"]) for r in jaccard.jaccard_components(spark.createDataFrame(texts, "k string, text string"), "k").collect()}
    assert got == {"a": ("a", 1), "b": ("a", 1), "c": ("c", 0), None: (None, 0), "d": ("d", 0)}


def test_jaccard_counts_every_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    monkeypatch.setattr(jaccard, "TILE", 7)
    random.seed(6)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(6))
    source, texts = [word() for _ in range(120)], {}
    for i in range(150):  # copies with 0 to 4 words changed: some link to some only
        w = list(source)
        for _ in range(i % 5):
            w[random.randrange(len(w))] = word()
        texts[i] = " ".join(w)
    for i in range(150, 160):
        texts[i] = " ".join(word() for _ in range(50))
    texts |= {160: texts[150], 161: texts[150] + " more", 162: "", 163: None}
    given = [*texts.items(), (0, texts[0]), (None, texts[150])]
    got = {r["doc_id"]: r["n_links"] for r in jaccard.op5_ngram_jaccard(spark.createDataFrame(given, "doc_id long, text string").repartition(5)).collect()}
    sets = {i: set(jaccard.shingle_set(x).tolist()) for i, x in texts.items()}
    wanted = {i: sum(i != j and bool(a) and len(a & b) * 5 >= len(a | b) * 4 for j, b in sets.items()) for i, a in sets.items()}
    assert got == wanted | {None: 0} and len(set(wanted.values())) > 10


# -- line dedup


def brute_lines(texts, least):
    seqs, first, gone = {}, {}, {}
    for i in sorted(texts):
        lines = enumerate((texts[i] or "").split("\n")) if texts[i] is not None else []
        seqs[i] = [(k, x, len(re.split(r"[\x20\x09-\x0D]+", x.strip(" \t\r\f\x0b")))) for k, x in lines if x.strip(" \t\r\f\x0b")]
    for i, seq in seqs.items():
        for a in range(len(seq)):
            size, key = 0, []
            for b in range(a, len(seq)):
                size += seq[b][2]
                key.append(seq[b][1])
                if size >= least:
                    if first.setdefault(tuple(key), (i, a)) < (i, a):
                        gone.setdefault(i, set()).update(x[0] for x in seq[a : b + 1])
    return gone


def test_line_dedup(spark):
    random.seed(9)
    pool = [" ".join(f"w{random.randrange(50)}" for _ in range(random.choice((1, 2, 5, 9, 30)))) for _ in range(25)]
    texts = {i: "\n".join(random.choice(pool) if random.random() < 0.8 else f"unique {i} {k}" for k in range(random.randrange(12))) for i in range(60)}
    texts |= {60: "\n".join(["again"] * 70), 61: None, 62: "", 63: "\n\n \n", 64: texts[3], 65: "x " * 60 + "\n\n" + pool[0]}
    texts[66] = texts[65]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for least in (20, 50):
        got = rows(line_dedup.without_repeats(df, min_words=least))
        wanted = brute_lines(texts, least)
        assert {i: set(r["removed"]) for i, r in got.items() if r["removed"]} == wanted
        for i, r in got.items():
            lines = None if texts[i] is None else [x for k, x in enumerate(texts[i].split("\n")) if k not in wanted.get(i, ())]
            assert r["text"] == (None if lines is None else "\n".join(lines))


# -- decontamination


def test_decontamination_finds_passages(spark):
    random.seed(4)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(5))
    items = {k: [word() for _ in range(n)] for k, n in enumerate((3, 6, 9, 14, 25, 40, 60, 150))}
    docs, wanted = [], set()
    for i in range(120):
        w = [word() for _ in range(random.randrange(200))]
        if i % 3 == 0:
            k = i % 8
            at = random.randrange(len(w) + 1)
            passage = list(items[k])
            if k == 7:
                passage[70] = word()  # one edit in 150 words stays over 0.8
            w[at:at] = [p.upper() if i % 2 else p + "," for p in passage]
            wanted.add((i, k))
        docs.append((i, " ".join(w)))
    bench = spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id long, text string")
    found = decontam.op1_decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == wanted


def test_hamming_lookup_is_complete():
    rng = np.random.default_rng(1)
    index = decontam.Index([(i, " ".join(f"w{rng.integers(10**6)}" for _ in range(40))) for i in range(50)])
    (kind,) = index.classes
    prints = index.classes[kind][0]
    near = prints.copy()
    for i in range(len(near)):
        for b in rng.choice(64, rng.integers(0, 9), replace=False):
            near[i] ^= np.uint64(1 << int(b))
    x, y = index.near(near, kind)
    all_pairs = np.bitwise_count(near[:, None] ^ prints[None, :]) <= decontam.RADIUS
    assert set(zip(x.tolist(), y.tolist())) == set(zip(*(v.tolist() for v in np.nonzero(all_pairs))))


def test_decontamination_equals_brute_force_on_near_copies():
    random.seed(9)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(5))
    items = [[word() for _ in range(n)] for n in (16, 20, 30, 41, 55, 59, 75, 100)]
    items.append([*items[4][:20], *items[4][8:12], *items[4][20:], *items[4][9:13]])  # with runs of four words that it has twice
    index = decontam.Index([(k, " ".join(v)) for k, v in enumerate(items)])
    texts = []
    for i in range(270):
        v = list(items[i % 9])
        for _ in range(1 + len(v) // 45):
            x = random.randrange(len(v))
            v[x : x + random.randrange(2)] = [word()] if random.random() < 0.7 else []
        if i % 4 == 0:
            cut = random.randrange(1 + len(v) // 9)
            v = v[cut:] if i % 8 else v[: len(v) - cut]
        around = [[word() for _ in range(random.randrange(0, 12))] for _ in range(2)]
        texts.append(" ".join(around[0] + v + around[1]))
    docs = [decontam.words(t) for t in texts]
    got = index.search(docs, 0.8)
    n = 0
    for d, found in zip(docs, got):
        wanted = []
        for k, v in index.items:
            spans = ((decontam.similarity(d[max(0, s) : max(0, s + len(v))], v), -max(0, s)) for s in range(1 - len(v), len(d)))
            s, start = max(spans)
            if s >= 0.8:
                wanted.append((k, s, -start))
        assert [(m["item_id"], m["similarity"], m["start_word"]) for m in found] == wanted
        n += sum(w[1] < 0.9 for w in wanted)
    assert n > 50  # near copies at 0.8 to 0.9


def test_decontamination_recall_by_length():
    rng = np.random.default_rng(4)
    random.seed(4)
    word = lambda: f"w{rng.integers(1 << 60)}"
    for n in (6, 9, 12, 16, 20, 24, 30, 40, 50, 59, 75, 100, 150, 300):
        found = wanted = 0
        for _ in range(120 if n < 100 else 40):
            item = [word() for _ in range(n)]
            copy, kind = list(item), random.randrange(4)
            size = random.randint(1, max(1, n // 10))
            at = random.randrange(n - size + 1)
            if kind == 0:  # words changed here and there
                for _ in range(random.randint(1, max(1, n // 40))):
                    copy[random.randrange(n)] = word()
            elif kind == 1:  # a run of words replaced
                copy[at : at + size] = [word() for _ in range(size)]
            elif kind == 2:  # words that are missing or more
                copy[at : at + 1] = [] if random.random() < 0.5 else [word(), copy[at]]
            else:  # cut at the borders
                cut = random.randint(0, size)
                copy = copy[cut : n - (size - cut)]
            text = " ".join([word() for _ in range(random.randrange(30))] + copy + [word() for _ in range(random.randrange(30))])
            doc, v = decontam.words(text), decontam.words(" ".join(item))
            best = max(decontam.similarity(doc[max(0, s) : max(0, s + n)], v) for s in range(1 - n, len(doc)))
            if best >= 0.8:
                got = decontam.Index([(1, " ".join(item))]).search([doc])[0]
                wanted += 1
                found += bool(got)
                assert not got or got[0]["similarity"] == best
        assert found >= 0.95 * wanted, (n, found, wanted)
        assert n < 16 or wanted >= 5


def test_decontamination_edges(spark):
    text = "one two three four five six seven eight"
    docs = spark.createDataFrame([(1, text, 0.5), (1, text, 0.5), (2, None, 0.5), (3, "", 0.5), (None, f"{text} and {text}", 0.5), (4, f"{text} nine " * 20_000, 0.5)], "doc_id long, text string, similarity double")
    bench = spark.createDataFrame([("a", text, 1), ("a", text, 2), ("b", text.upper(), 1), ("b", "!", 1), (None, text, 1), ("c", None, 1)], "item_id string, text string, doc_id int")
    found = sorted(((r["doc_id"] or 0, r["item_id"], r["similarity"], r["start_word"]) for r in decontam.op1_decontaminate(docs, bench).collect()))
    assert found == [(i, k, 1.0, 0) for i in (0, 1, 1, 4) for k in "ab"][:2] + sorted([(1, "a", 1.0, 0), (1, "a", 1.0, 0), (1, "b", 1.0, 0), (1, "b", 1.0, 0), (4, "a", 1.0, 0), (4, "b", 1.0, 0)])
    assert decontam.op1_decontaminate(docs, bench.limit(0)).count() == 0 and decontam.op1_decontaminate(docs.limit(0), bench).count() == 0
    kept = decontam.keep_clean(docs, bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3] and kept.columns == docs.columns


# -- license scan


def test_license_scan(spark):
    random.seed(2)
    pad = lambda n: " ".join(random.choice(("the", "of", "ing", "public", "note")) + str(random.randrange(99)) for _ in range(n))
    docs, wanted = [], set()
    for i, (name, notice) in enumerate(license_scan.NOTICES * 3):
        docs.append((i, f"{pad(random.randrange(60))} {notice.upper() if i % 2 else notice} {pad(random.randrange(60))}"))
        wanted.add((i, name))
    docs += [(900, pad(100)), (901, ""), (902, None), (903, "license")]
    got = {(r["doc_id"], r["license_id"]) for r in license_scan.op4_license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert wanted <= got and not {d for d, _ in got} & {900, 901, 902, 903}
    assert license_scan.bands_for(1, 8, 5) >= 10


def brute_licenses(texts):
    """The notices that a window of their class holds, by the definition."""
    words = lambda t: [w for w in (re.sub(r"^[^\w]+|[^\w]+$", "", x.replace("_", " ").strip()) for x in t.lower().split()) if w]
    found = set()
    for i, t in texts.items():
        ws = words(t or "")
        for name, notice in license_scan.NOTICES:
            ts = words(notice)
            span, size = license_scan.span_of(len(ts)), min(5, len(ts))
            grams = {tuple(ts[k : k + size]) for k in range(max(1, len(ts) - size + 1))}
            for start in range(0, max(span, len(ws)), span):
                w = ws[start : start + 2 * span]
                have = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))}
                if w and len(grams & have) >= 0.8 * len(grams):
                    found.add((i, name))
    return found


def test_license_scan_equals_brute_force_with_edits(spark):
    random.seed(12)
    pad = lambda n: [random.choice("the of in public note file work".split()) + random.choice(["", str(random.randrange(99))]) for _ in range(n)]
    texts = {}
    for i in range(160):  # edited notices, near the threshold of containment and on both sides of it
        ws = license_scan.NOTICES[i % len(license_scan.NOTICES)][1].split()
        for _ in range(random.randrange(0, 1 + len(ws) // 8)):
            ws[random.randrange(len(ws))] = "x"
        texts[i] = " ".join(pad(random.randrange(50)) + ws + pad(random.randrange(50)))
    texts |= {900: " ".join(pad(3000)), 901: "", 902: None, 903: texts[0], 904: (texts[1] + " ") * 300}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()] + [(0, texts[0], 1)], "doc_id long, text string, license_id int")
    got = {(r["doc_id"], r["license_id"]) for r in license_scan.op4_license_scan(df).collect()}
    wanted = brute_licenses(texts)
    assert got <= wanted and len(got) >= 0.97 * len(wanted) and len(wanted) > 60


def test_anchors_hit_every_shingle():
    texts = [license_scan.NOTICES[k][1].lower().split() for k in range(8)]
    chosen = set(license_scan.anchors(texts))
    assert all(chosen & set(t[i : i + 5]) for t in texts for i in range(max(1, len(t) - 4)))


# -- packing


def test_best_fit_equals_a_linear_search():
    random.seed(6)
    sizes = [random.randrange(1, 101) for _ in range(400)]
    rooms, wanted = [], []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [r for r in rooms if r >= sizes[i]]
        if fits:
            rooms[rooms.index(min(fits))] -= sizes[i]
        else:
            rooms.append(100 - sizes[i])
        wanted = sorted(rooms)
    got = packing.best_fit(sizes, 100)
    assert sorted(100 - sum(sizes[i] for i in row) for row in got) == wanted and sorted(itertools.chain(*got)) == list(range(400))


def test_packed_rows_as_files(spark, tmp_path):
    df = spark.createDataFrame([("a", "one two three " * 30), ("b", None), (None, "x")], "k string, text string")
    rows = packing.packed(df, "k", length=16)
    packing.write_packed(rows, f"file://{tmp_path}/p")
    back = packing.position_ids(spark.read.parquet(f"file://{tmp_path}/p"), 16).collect()
    for r in back:
        wanted = [i - max(x for x in r["resets"] if x <= i) for i in range(16)]
        assert r["position_ids"] == wanted and len(np.frombuffer(r["ids"], dtype="<u2")) == 16
    assert {d for r in back for d in r["doc_ids"]} == {"a", "b", None}


def test_packing_is_lossless(spark, sf, docs):
    enc, _ = reference_encoding()
    back = collections.defaultdict(dict)
    for r in packing.packed(table(spark, sf, "documents"), length=256).collect():
        ids = np.frombuffer(r["ids"], dtype="<u2")
        assert len(ids) == 256 and r["cu_seqlens"][-1] == r["n_tokens"] and r["resets"][: r["n_segments"]] == r["cu_seqlens"][:-1]
        for d, o, a, b in zip(r["doc_ids"], r["doc_offsets"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            back[d][o] = ids[a:b].tolist()
    for i, t in docs.items():
        assert [x for o in sorted(back[i]) for x in back[i][o]] == [*enc.encode_ordinary(t or ""), packing.END]


# -- HTML


def main_text(source, weights=None):
    return html_main.Page(source).text(weights or html_main.Weights())


def test_html_main_text(spark, sf):
    page = "<body><div id='top-menu'><a>Home</a></div><div class='content'><h1>Title</h1><p>One two <b>th</b>ree &amp; four.<div class='ad'>buy now</div><p>Five.<ul><li>six more<li>seven more</ul></div><div class='comments'><p>a long reader comment with words</div><footer>f</footer></body>"
    assert main_text(page) == "Title One two three & four. Five. six more seven more"
    assert main_text("<p>") == "" and main_text("plain &lt; text") == "plain < text" and main_text("<article>a<script>var x='</p>'</script> b") == "a b"
    assert main_text("<p>&am<b>p;</b> x y z") == "&amp; x y z" and main_text("<div/>a b c <a href=/x/>d</a> e") == "a b c d e"
    got = rows(html_main.op7_html_main(table(spark, sf, "pages")), "page_id")
    for r in table(spark, sf, "pages").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        import html

        wanted = " ".join(html.unescape(re.sub(r"<br>|</?(p|h1)>", "\n", inner).replace("<b>", "")).split())
        assert got[r["page_id"]]["text"] == wanted and got[r["page_id"]]["n_chars"] == len(wanted)


LEFT_OUT = [
    "<nav><ul><li><a href='/'>Home page</a></ul></nav>", "<div class='ad'>buy now and save</div>", "<aside><p>far from the text</p></aside>", "<form><label>Name</label><input><button>Send it</button></form>",
    "<div id='cookie-notice'><p>we use them</p></div>", "<script>var a = '<p>no text</p>'</script>", "<style>p { color: red }</style>", "<section class='comments'><article class='comment'><p>a reader says a few words</p></article></section>",
    "<footer>the end</footer>", "<ul class='share'><li><a>One</a><li><a>Two</a></ul>", "<div role='navigation'><a>x</a> <a>y</a></div>", "<div hidden>unseen words</div>", "<!-- a note -->", "<select><option>red<option>blue</select>", "<nav>x</nav>",
]
BLOCKS = [
    ("<h1>A title</h1>", "A title"), ("<p>One two three.</p>", "One two three."), ("<ul>" + "".join(f"<li>w{i}</li>" for i in range(10)) + "</ul>", " ".join(f"w{i}" for i in range(10))), ("<p>four more words here</p>", "four more words here"),
    ("<table><tr><th>k<th>v<tr><td>a<td>1</table>", "k v a 1"), ("<p><a href='a'>all</a> <a href='b'>of</a> <a href='c'>links</a></p>", "all of links"), ("<figure><img src='x'><figcaption>A picture</figcaption></figure>", "A picture"),
    ("<dl><dt>term<dd>what it is</dl>", "term what it is"), ("<blockquote><p>said so</p></blockquote>", "said so"), ("<ol><li>x<li>y</ol>", "x y"), ("<p>b</p>", "b"),
]


@pytest.mark.parametrize("fitted", [False, True])
@pytest.mark.parametrize("tag", ["article", "main", "div class='content'", "div id='post-7'"])
def test_html_left_out_elements_split_nothing(spark, sf, fitted, tag):
    learnt = html_main.fit(table(spark, sf, "pages")) if fitted else html_main.Weights()
    want = " ".join(t for _, t in BLOCKS)
    for left in LEFT_OUT:
        for k in range(len(BLOCKS) + 1):
            inner = "".join(b for b, _ in BLOCKS[:k]) + left + "".join(b for b, _ in BLOCKS[k:])
            source = f"<html><body><nav><a>Home</a></nav><{tag}>{inner}</{tag.split()[0]}>{left}<footer>f g</footer></body></html>"
            assert main_text(source, learnt) == want, (left, k)
    every = "".join(b + x for (b, _), x in zip(BLOCKS, LEFT_OUT))
    assert main_text(f"<body><{tag}>{every}</{tag.split()[0]}></body>", learnt) == want


def test_html_names_seen_outside_cost_nothing_inside(spark):
    lists = "<div class='more'><ul>" + "<li><a>some other page</a>" * 30 + "</ul></div>"
    marked = [(i, f"<body>{lists}<article><h1>T {i}</h1><p>one two three</p></article>{lists}</body>") for i in range(60)]
    learnt = html_main.fit(spark.createDataFrame(marked, "page_id long, html string"))
    assert learnt.of("li") > 10 > 1 > learnt.of("li@main") and learnt.of("a@main") < 1
    assert main_text(f"<body>{lists}<article><h1>T</h1><p>one two</p><ul><li>a<li><a>b</a><li>c</ul><p>d</p></article>{lists}</body>", learnt) == "T one two a b c d"
    assert main_text(f"<body>{lists}<div class='text'><h1>T</h1><p>one two</p></div>{lists}</body>", learnt) == "T one two"


def test_html_equal_sums_take_the_earlier_and_shorter():
    assert html_main.best_region([1.0, -1.0, 1.0]) == (0, 1) and html_main.best_region([-1.0, 2.0, -3.0, 2.0, 0.0]) == (1, 2) and html_main.best_region([0.0, 0.0]) == (0, 0)
    cut = html_main.Weights({"hr": (50, 0)}, 30.0)
    assert main_text("<p>one two</p><hr><p>three four</p>", cut) == "one two"


def test_html_region_is_the_maximum_over_all():
    random.seed(8)
    names = ("p", "div", "h1", "li", "section", "span", "article", "x")
    weights = html_main.Weights({"p": (0, 40), "div": (30, 10), "li": (90, 9), "article": (50, 0)}, 20.0)
    for _ in range(150):
        source = "".join(random.choice(("w " * random.randrange(6), f"<{random.choice(names)}>", f"</{random.choice(names)}>")) for _ in range(random.randrange(30)))
        page = html_main.Page(source)
        scores = page.scores(weights, page.passed_over(weights))
        sums = {(a, b): sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)}
        best = max(sums.values(), default=0)
        lo, hi = html_main.best_region(scores)
        assert sum(scores[lo:hi]) == pytest.approx(max(0, best)) and (lo == hi) == (best <= 0)


def test_html_weights_decide(spark):
    pages = [(i, f"<body><div class='teaser'>{'word ' * 9}</div><article><h1>T {i}</h1><p>one two three</p><div class='lead'>four five</div></article><section class='more'>{'other ' * 12}</section></body>") for i in range(40)]
    df = spark.createDataFrame(pages, "page_id long, html string")
    learnt = html_main.fit(df)
    assert learnt.of(".teaser") > 10 > learnt.of("+lead") and learnt.most == 21
    unmarked = pages[0][1].replace("article", "div")
    assert main_text(unmarked, learnt) == "T 0 one two three four five"
    assert main_text(unmarked) == f"{'word ' * 9}T 0 one two three four five {'other ' * 12}".strip()
    cut = html_main.Weights({"p": (50, 0)}, 30.0)
    assert main_text("<p>one two</p><h2>three four five</h2>", cut) == "three four five" and main_text("<p>one two</p><h2>three four five</h2>") == "one two three four five"


def test_html_main_text_in_wrappers():
    menu, words = "<nav><a>Home</a> <a>News</a></nav>", "One two three four five six seven eight nine ten."
    side = "<div class='sidebar'>far from it</div><div id='comments'><article class='comment'><p>a reader says this and that</article></div>"
    opens = [("<div class='layout has-sidebar'>", "</div>"), ("<div class='with-sidebar'>", "</div>"), ("<div id='no-sidebar'>", "</div>"), ("<form>", "</form>"), ("<div class='sidebar-left'>", "</div>"), ("<div style='display:none'>", "</div>")]
    for tag in ("article", "main", "div class='content'"):
        inner = f"<{tag}><h1>Title</h1><p>{words}<div class='ad'>buy now</div></{tag.split()[0]}>"
        for a, b in opens:
            assert main_text(f"<body>{menu}{a}{inner}{side}{b}<footer>f</footer></body>") == f"Title {words}", (tag, a)
    assert main_text(f"<main><div class='grid with-search'><div class='search'><p>{words}</div></div></main>") == words
    long = "<p>a reader says this and that at length and more than the page itself does</p>" * 3
    assert main_text(f"<main><div class='post'><p>{words}</div><div class='comments'>{long}</div></main>") == words
    assert main_text(f"<div class='post'><p>{words}</div><nav><ul>{'<li><a>some other page</a>' * 20}</ul></nav>") == words
    assert main_text(f"<article><div class='article-header'><h1>Title</h1></div><p>{words}</p></article>") == f"Title {words}"
    assert main_text(f"<div class='content has-sidebar'><p>{words}</p></div>") == words
    assert main_text(f"<article><p>{words}</p><section class='discussion'><p>{words}</p></section></article>") == f"{words} {words}"


def test_html_edges(spark):
    df = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "<p>a b", "x"), (3, "u", "<p>a b", "x"), (None, "u", "<nav>n</nav>", "x")], "page_id long, url string, html string, main_text string")
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in html_main.op7_html_main(df).collect()) == [(0, "", 0), (1, "", 0), (2, "", 0), (3, "a b", 3), (3, "a b", 3)]
    assert html_main.op7_html_main(df.limit(0)).count() == 0
    import time

    for deep in ("<ul><li>" * 50_000, "<div>" * 100_000, "<div>" * 50_000 + "<li>" * 50_000):
        began = time.time()
        main_text(deep + "a b")
        assert time.time() - began < 5


# -- language


def plain_ftrl(rows, classes, features, alpha, beta, l1, l2, epochs):
    """Follow-the-regularised-leader, one weight at a time."""
    z, n = np.zeros((classes, features)), np.zeros((classes, features))

    def weight(c, i):
        if abs(z[c, i]) <= l1:
            return 0.0
        return -(z[c, i] - np.sign(z[c, i]) * l1) / ((beta + np.sqrt(n[c, i])) / alpha + l2)

    for _ in range(epochs):
        for at, x, y in rows:
            scores = np.array([sum(weight(c, i) * v for i, v in zip(at, x)) for c in range(classes)])
            p = np.exp(scores - scores.max())
            p /= p.sum()
            old = {(c, i): weight(c, i) for c in range(classes) for i in at}
            for c in range(classes):
                for i, v in zip(at, x):
                    g = (p[c] - (c == y)) * v
                    sigma = (np.sqrt(n[c, i] + g * g) - np.sqrt(n[c, i])) / alpha
                    z[c, i] += g - sigma * old[c, i]
                    n[c, i] += g * g
    return np.array([[weight(c, i) for i in range(features)] for c in range(classes)])


def test_ftrl_equals_a_plain_one(monkeypatch):
    monkeypatch.setattr(langid, "BUCKETS", 12)
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(40):
        at = np.sort(rng.choice(12, rng.integers(1, 6), replace=False))
        rows.append((at, rng.random(len(at)), int(rng.integers(3))))
    options = dict(alpha=0.7, beta=0.1, l1=0.02, l2=0.05, epochs=2)
    assert np.allclose(langid.ftrl(rows, 3, **options), plain_ftrl(rows, 3, 12, **options))


def test_language_edges_and_ties(spark):
    texts = ["the cat and the dog", "der hund und die katze", "le chat et le chien", "el perro y el gato"] * 12
    langs = ["en", "de", "fr", "es"] * 12
    rows = [(i, t, k, "x") for i, (t, k) in enumerate(zip(texts, langs))] + [(90, None, "en", "x"), (91, "123 !?", "de", "x"), (92, "the dog " * 30_000, None, "x"), (0, texts[0], "en", "x"), (None, "le chien", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {}
    for r in langid.op10_language_id(df).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert got[90] == got[91] == [("und", 0.0)] and got[92][0][0] == "en" and len(set(got[0])) == 1 and len(got[0]) == 2
    assert all(got[i][0][0] == k for i, k in enumerate(langs))
    none = langid.op10_language_id(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


def test_language_accuracy(spark, sf):
    got = rows(langid.op10_language_id(table(spark, sf, "documents")))
    held = [(r["lang"], got[r["doc_id"]]["lang_pred"]) for r in table(spark, sf, "documents").collect() if got[r["doc_id"]]["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.9
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_registered():
    names = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.queries())
    assert names == list(range(1, 14)) and set(queries.oracle_sql()) <= set(queries.queries())
