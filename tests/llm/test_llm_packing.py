import struct
import zlib
from collections import Counter, defaultdict


import numpy as np
import pytest
from tokenizers import Tokenizer

from payrisk.llm import packing

PATH = packing.default_tokenizer()
WEIRD = ["", " ", "  ", "a", "a b", "a  b", "a \tb", "a\n b", "a \n b", "a   b ", "\n\nx y\n", "it's we'll I'd", "x<|endoftext|>y <|endoftext|> z", "é 漢字   z",
         " lead", "tail ", "a  b", "a  b", "1 22  333", "🙂 🙂", "\t a", "a\r\n b c"]


def test_same_ids_as_the_file():
    whole = Tokenizer.from_file(PATH)
    tokenizer = packing.FileTokenizer(PATH)
    assert tokenizer.fast is not None
    got = tokenizer.encode(WEIRD)
    assert [x.tolist() for x in got] == [whole.encode(t, add_special_tokens=False).ids for t in WEIRD]


def check(pieces, rows, window):
    whole = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for i, t, *_ in rows:
        want[i].append(tuple([*whole.encode(t or "", add_special_tokens=False).ids, 1]))
    for i in want:  # rows of one id: their pieces, in some order, give the same multiset of ids
        mine = [p for p in pieces if p["doc_id"] == i]
        assert sorted(x for (x,) in struct.iter_unpack("<I", b"".join(p["ids"] for p in mine))) == sorted(x for t in want[i] for x in t)
        if len(want[i]) == 1:
            mine.sort(key=lambda p: p["start"])
            ids, at = want[i][0], 0
            for p in mine:
                assert p["start"] == at and p["doc_tokens"] == len(ids)
                assert np.frombuffer(p["ids"], "<u4").tolist() == list(ids[at : at + p["length"]])
                at += p["length"]
            assert at == len(ids)
    by = defaultdict(list)
    for p in pieces:
        by[p["sequence_id"]].append((p["offset"], p["length"]))
    for spans in by.values():
        at = 0
        for off, n in sorted(spans):
            assert off == at
            at += n
        assert at <= window
    return by


def test_whole_round_trip(spark, odd, docs):
    rows = [(i, " ".join(f"w{(i // 3) * 7 + k % 11}" for k in range(20 + i)), "en", "s") for i in range(60)]
    for df in (odd, docs(rows)):
        raw = [(r["doc_id"], r["text"]) for r in df.collect()]
        pieces = packing.pack(df, PATH, window=128).collect()
        by = check(pieces, raw, 128)
        assert sum(sum(n for _, n in s) < 128 for s in by.values()) <= 1
    assert packing.pack(docs([]), PATH).count() == 0
    got = packing.packing_query(docs(rows))
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = Tokenizer.from_file(PATH).encode(rows[0][1]).ids + [1]
    r = [r for r in got.collect() if r["doc_id"] == 0]
    assert sum(x["length"] for x in r) == len(ids)
    if len(r) == 1:
        assert r[0]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_bm25_against_the_formula():
    rng = np.random.default_rng(0)
    ids = [rng.integers(0, 12, n).astype("<u2") for n in (30, 25, 40, 2, 1)]
    idf = rng.uniform(0.1, 3, packing.TERMS)
    shard = packing.Shard(ids, idf, 20.0)
    doc, term = packing.term_pairs(np.concatenate(ids), np.array([len(x) for x in ids]))
    tf = [dict(zip(*np.unique(term[doc == k], return_counts=True))) for k in range(5)]
    q = sorted((t for t in tf[0] if sum(t in f for f in tf) > 1), key=lambda t: (-idf[t], t))[: packing.QUERY_TERMS]
    for k in range(5):
        norm = packing.K1 * (1 - packing.B + packing.B * (len(ids[k]) - 1) / 20.0)
        assert shard.scores(0)[k] == pytest.approx(sum(idf[t] * tf[k][t] * (packing.K1 + 1) / (tf[k][t] + norm) for t in q if t in tf[k]))


def test_neighbours_share_a_window():
    """Copies of the seed come before unrelated documents."""
    rng = np.random.default_rng(1)
    seed = rng.integers(10, 5000, 300).astype("<u2")
    other = [rng.integers(10, 5000, 300).astype("<u2") for _ in range(20)]
    ids = [seed, *other, seed.copy()]
    pieces = packing.Packer(600, 0).fill(ids, np.ones(packing.TERMS), 300.0)
    assert [p[0] for p in pieces if p[3] == 0] == [0, 21]


def test_all_terms_vote():
    """A long seed's many common pairs outweigh a few rare ones."""
    rare, common = np.arange(100, 130), np.arange(1000, 1400)
    seed = np.concatenate([rare, common]).astype("<u2")
    ids = [seed, rare.astype("<u2"), common.astype("<u2")]
    idf = np.ones(packing.TERMS)
    idf[packing.term_pairs(rare, np.array([len(rare)]))[1]] = 3.0
    scores = packing.Shard(ids, idf, 400.0).scores(0)
    assert scores[2] > scores[1] > 0


def test_weights_by_pair(spark, docs):
    """Document frequencies belong to pairs, not to places that pairs share."""
    flat = np.random.default_rng(2).integers(0, 50_000, 4000)
    lengths = np.array([len(flat)])
    keys, places = packing.pair_keys(flat, lengths)[1], packing.term_pairs(flat, lengths)[1]
    assert len(np.unique(places)) < len(np.unique(keys)) == len({(a, b) for a, b in zip(flat[:-1].tolist(), flat[1:].tolist())})
    texts = [[10, 11, 12, 13], [10, 11, 12], [10, 11, 10, 11], [50, 51]]
    rows = [(0, len(x), np.array(x, "<u2").tobytes()) for x in texts]
    got = packing.term_weights(spark.createDataFrame(rows, "task long, n long, ids binary"), 4, 13).collect()
    idf = dict(zip(np.frombuffer(b"".join(r["keys"] for r in got), "<u8").tolist(), np.frombuffer(b"".join(r["idf"] for r in got), "<f8")))
    assert idf == {10 << 32 | 11: pytest.approx(np.log1p(1.5 / 3.5)), 11 << 32 | 12: pytest.approx(np.log1p(2.5 / 2.5))}


def test_keys_of_pairs_are_packed_and_unpacked():
    for top in (1 << 16, 1 << 20):
        ids = np.random.default_rng(1).integers(0, top, size=(1000, 2)).astype(np.uint64)
        key = np.sort(ids[:, 0] << np.uint64(32) | ids[:, 1])
        blob = packing.packed(key)
        assert len(blob) == (4 if top == 1 << 16 else 8) * len(key) and (packing.unpacked(blob, len(key)) == key).all()
    assert len(packing.unpacked(packing.packed(np.zeros(0, np.uint64)), 0)) == 0


@pytest.mark.parametrize("top,kind", [(9, "<u2"), (1 << 16, "<u2"), (1 << 20, "<u4")])
def test_pair_counts_against_a_plain_count(top, kind):
    rng = np.random.default_rng(top)
    ids = [rng.integers(0, top, n).astype(kind) for n in (0, 1, 2, 50, 400, 1)]
    plain = Counter((int(a) << 32 | int(b), d) for d, x in enumerate(ids) for a, b in zip(x[:-1], x[1:]))
    pair, doc, n = packing.pair_counts(ids)
    assert list(zip(zip(pair.tolist(), doc.tolist()), n.tolist())) == sorted(plain.items())
    known = np.unique(pair)[::2]
    term, doc, n = packing.Vocabulary(known)(ids)
    want = {k: c for k, c in plain.items() if k[0] in set(known.tolist())}
    assert list(zip(zip(known[term].tolist(), doc.tolist()), n.tolist())) == sorted(want.items())


def test_split_equals_the_tokenizer_on_spaces():
    words = packing.tokenizer(packing.default_tokenizer())
    for text in ("", " ", "  a", "a  ", "a \n\n b", "\n\n", "a\t", "it's 'S we'll\u00a0\u00a0x", "1 2  3\r\n", "..  !!\u3000\u3000", "\u0600\u0661 \u00e9"):
        assert words.ids(text) == words.tokenizer.encode(text, add_special_tokens=False).ids


SPACES = [chr(c) for c in (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def test_texts_cut_at_runs_of_spaces_give_the_same_ids():
    """A text is cut where the automaton would take a run of spaces as one; U+001C to U+001F and U+200B are no spaces."""
    words = packing.tokenizer(packing.default_tokenizer())
    assert words.of_part is not None
    plain = "it's 12 naïve, words "
    for s in (*SPACES, "\x1c", "\x1f", "​"):
        for run in (s, s + s, " " + s, s + " ", "\n" + s + "\n", s * 5 + " "):
            for text in (f"a{run}b", f"{run}'s{run}1{run}", f"{plain * 30}{run}b. {plain * 30}{run}"):
                assert words.ids(text) == words.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    long = f"{plain * 30}\n\n  b" * 3
    parts = packing.PARTS.split(long)
    assert len(parts) > 1 and "".join(parts) == long and len(long) >= packing.PART_CHARS * len(parts)


def test_common_terms_are_scored_by_the_matrix():
    """Lists of terms in many documents are not walked for each seed; all scores follow the formula and are exact, so copies tie."""
    rng = np.random.default_rng(3)
    ids = [np.concatenate([rng.integers(0, 8, 60), rng.integers(100, 130, 40)]).astype("<u2") for _ in range(90)]
    ids = [*ids, np.array([7], "<u2"), *(x.copy() for x in ids[:30])]
    doc, pair = packing.pair_keys(np.concatenate(ids), np.array([len(x) for x in ids]))
    keys = np.unique(pair)
    idf, n = rng.uniform(0.1, 3, len(keys)), np.array([len(x) for x in ids])
    shard = packing.Shard(ids, idf, 80.0, packing.Vocabulary(keys))
    assert len(shard.gives) and len(shard.size) and shard.size.max() * packing.COMMON < len(ids)
    tf = np.zeros((len(ids), len(keys)))
    np.add.at(tf, (doc, np.searchsorted(keys, pair)), 1)
    norm = packing.K1 * (1 - packing.B + packing.B * (n - 1) / 80.0)
    gives = idf * tf * (packing.K1 + 1) / (tf + norm[:, None])
    shared = (tf > 0).sum(0) > 1
    free = rng.random(len(ids)) < 0.7
    for k in range(len(ids)):
        got = shard.scores(k, free)
        assert got == pytest.approx(gives[:, shared & (tf[k] > 0)].sum(1))
        assert (got[:30] == got[91:]).all() and (got == packing.Shard.scores(shard, k)).all()
        assert (got / packing.GRAIN == np.rint(got / packing.GRAIN)).all()


@pytest.mark.parametrize("top", [1 << 16, 1 << 20])
def test_sums_and_weights_of_tasks_read_in_parts(spark, top):
    rng = np.random.default_rng(top)
    key = (rng.integers(top - 5, top, 300) << 32 | rng.integers(0, 5, 300)).astype(np.uint64)
    count = rng.integers(1, 1 << 20, 300).astype(np.uint32)
    plain = Counter()
    for k, c in zip(key.tolist(), count.tolist()):
        plain[k] += c
    got = packing._summed([key[:100], key[100:]], [count[:100], count[100:]])
    assert list(zip(got[0].tolist(), got[1].tolist())) == sorted(plain.items())
    kind = "<u2" if top == 1 << 16 else "<u4"
    texts = [(int(t), rng.integers(top - 6, top, 9).astype(kind)) for t in rng.integers(0, 3, 40)]
    own, all_docs = Counter(), Counter()
    for t, x in texts:
        for k in {int(a) << 32 | int(b) for a, b in zip(x[:-1], x[1:])}:
            own[t, k] += 1
            all_docs[k] += 1
    rows = spark.createDataFrame([(t, len(x), x.tobytes()) for t, x in texts], "task long, n long, ids binary").repartition(4)
    got = {}
    for r in packing.term_weights(rows, len(texts), 360).collect():
        got |= {(r["task"], k): w for k, w in zip(np.frombuffer(r["keys"], "<u8").tolist(), np.frombuffer(r["idf"], "<f8").tolist())}
    assert got == {(t, k): pytest.approx(np.log1p((40 - all_docs[k] + 0.5) / (all_docs[k] + 0.5))) for (t, k), c in own.items() if c > 1}
