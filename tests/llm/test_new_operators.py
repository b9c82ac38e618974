"""Spelling variants, bit planes and the conversation trie against brute force, on odd rows, and in their parts."""

import hashlib
import io
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymart.llm import bit_planes, conversation_trie as trie, spelling, wordcodes

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", "   ", " a  b\n\n\nc \t d", "x y z  ", "don't we'll I'M it's,", "<|endoftext|> a<|endoftext|>B", "a\x1fb c", " word. Word, w1rd? 12,5",
       "Été ÉTÉ İstanbul ΣΑΣ ſ K", "a\x0bb\x0cc\x85d", "\n", "日本語 テキスト、です。", "a\x1cb! !\x1c?", "é ́a Á ", "!! ?!  ...\n... ", "x" * 5000,
       "it 's , ' s", "(foo) foo); foo's", "Zeile eins\nZeile zwei,\n\nZeile drei\n", "\0 nul\0 \0\0", "<|startoftext|>"]


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelt(docs):
    """Words and their counts by plain Python."""
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            count[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in count.items() if n >= 2 and len(w) >= 7}


def test_spelling_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    stems = ["".join(rng.choice(list("abé"), int(rng.integers(7, 10)))) for _ in range(25)] + ["zzzzzzz", "zzzzzzzz", "abababab", "babababa", "x" * 3000, "x" * 3001, "×÷×÷×÷×"]
    words = []
    for stem in stems:
        words += [stem] * int(rng.integers(20, 40))
        for _ in range(3):
            k = int(rng.integers(0, len(stem)))
            words += [stem[:k] + str(rng.choice(list("abÀq"))) + stem[k + int(rng.integers(0, 2)):]] * int(rng.integers(1, 4))
            words += [stem[:k] + stem[k + 1:]] * int(rng.integers(1, 3))
    rng.shuffle(words)
    docs = [(n, " ".join(words[n * 40:n * 40 + 40]).upper() if n % 3 == 0 else "1".join(words[n * 40:n * 40 + 40])) for n in range(len(words) // 40 + 1)]
    docs += [(None, "Tobacco tobacco"), (None, None), (7, ""), (7, "tobacco tobacco"), (7, "tobacco tobacco")]
    count = spelt(docs)
    close = defaultdict(list)
    for a, b in itertools.permutations(count, 2):
        if near(a, b):
            close[a].append(b)
    best = {a: min(bs, key=lambda b: (-count[b], b)) for a, bs in close.items()}
    form = {a: b for a, b in best.items() if count[b] >= 10 * count[a]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, word string")
    got = {tuple(r) for r in spelling.grouped(df).collect()}
    assert got == {(w, form.get(w), root(w), n, len(close[w]), count[form[w]] if w in form else None) for w, n in count.items()}
    assert len(form) > 10 and len(close) > 40
    assert spelling.grouped(df.limit(0)).count() == 0


def test_chains_of_forms_are_followed_to_the_end(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(9)] + [("x", "y")]
    got = dict(map(tuple, spelling.roots(spark.createDataFrame(chain, "word string, form string"), 9).collect()))
    assert got == {**{f"w{k}": "w9" for k in range(9)}, "x": "y"}


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = np.random.default_rng(1)
    word, place, cost = [], [], []
    for w in range(300):
        places = np.sort(rng.choice(12, int(rng.integers(3, 9)), replace=False))
        word += [w] * len(places)
        place += places.tolist()
        cost += rng.integers(1, 6, len(places)).tolist()
    word, place, cost = np.array(word), np.array(place), np.array(cost)
    chosen = spelling.pivots(word, place, cost)
    for w in range(300):
        own = np.flatnonzero(word == w)
        picked = own[chosen[own]]
        least = min(cost[a] + cost[b] for a, b in itertools.combinations(own, 2) if place[b] - place[a] >= 2)
        assert len(picked) == 2 and place[picked[1]] - place[picked[0]] >= 2 and cost[picked].sum() == least


@pytest.mark.parametrize("path, units", [(WORDS, wordcodes.words), (BYTES, wordcodes.led_words)])
@pytest.mark.parametrize("special", [True, False])
def test_units_give_the_tokenizers_ids(path, units, special):
    import pyarrow as pa

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special
    for coder in [wordcodes.WordCoder(tokenizer, units, hold=2_000)] * 3 + [wordcodes.WordCoder(tokenizer, units, kept=(path, special)) for _ in range(2)]:
        ids, length = coder.encode(pa.array(ODD, pa.string()).cast(pa.binary()))
        parts = np.split(ids, np.cumsum(length)[:-1])
        assert [p.tolist() for p in parts] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in ODD]
    assert coder.encode(pa.array([], pa.binary()))[0].tolist() == []
    assert coder.encode(pa.array([b"caf\xe9 x"], pa.binary()))[1].tolist() == [len(tokenizer.encode("caf� x", add_special_tokens=False).ids)]


def test_words_are_cut_before_blanks_without_marking_them():
    """The bytes of texts with ASCII blanks are cut where they lie; empty texts, blanks at both ends and other texts' ends make no difference."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = ["a b", "", " a", "a ", " ", "", "\n\nx  y\t z", "é ñ\x0b", "z", "", "plain"]
    for own in (texts, texts[2:5], [], [""], texts + ["wide\u2003blank\u00a0s b"]):
        marked = pc.replace_substring_regex(pa.array(own, pa.string()), f"([^{wordcodes.SPACE}])([{wordcodes.SPACE}])", rf"\1{wordcodes.CUT}\2")
        want = [t.split(wordcodes.CUT) for t in marked.to_pylist()]
        assert wordcodes.led_words(pa.array(["x y", *own, "x"], pa.string()).slice(1, len(own))).to_pylist() == want


def test_words_of_letters_come_to_the_model_in_one_piece(monkeypatch):
    """Marks behind words are cut off for all words at once, and words that differ in them only are encoded once."""
    import pyarrow as pa

    coder = wordcodes.WordCoder(Tokenizer.from_file(BYTES), wordcodes.led_words)
    learnt, learn = [], coder._learn_words
    monkeypatch.setattr(coder, "_learn_words", lambda words: (learnt.extend(words.to_pylist()), learn(words)))
    coder.encode(pa.array(["soonest, soonest. latest! soonest", "latest latest; (odd) latest"]))
    assert sorted(learnt) == [" latest", " soonest", "latest", "soonest"]


def test_bit_planes_round_trip(spark, tmp_path):
    tokenizer = Tokenizer.from_file(BYTES)
    docs = [(n * 7 % 31 - 3, t) for n, t in enumerate(ODD)] + [(None, "no id"), (5, "same id a"), (5, "same id b"), (5, "same id b")]
    df = spark.createDataFrame([(*d, 1, "p") for d in docs], "doc_id long, text string, ids int, path string")
    manifest = bit_planes.write(df, BYTES, str(tmp_path / "out"), block=64, shards=3)
    got = [tuple(r) for r in bit_planes.stored(manifest).orderBy("start").collect()]
    assert Counter((r[0], r[2], r[3]) for r in got) == Counter(
        (i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, t in docs for ids in [tokenizer.encode(t or "", add_special_tokens=False).ids + [0]])
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]])[:-1].tolist()
    assert [r[0] for r in got] == sorted((d[0] for d in docs), key=lambda i: (i is not None, i or 0))
    file = manifest.orderBy(F.desc("ids")).first()
    whole = bit_planes.read_ids(file["path"], 0, file["ids"])
    assert len(whole) == file["ids"] and (bit_planes.read_ids(file["path"], 60, 300) == whole[60:360]).all()
    assert bit_planes.stored(bit_planes.write(df.limit(0), BYTES)).count() == 0


def test_only_files_of_the_manifest_count(spark, tmp_path):
    df = spark.createDataFrame([(k, f"text {k}") for k in range(20)], "doc_id long, text string")
    manifest = bit_planes.write(df, BYTES, str(tmp_path / "out"), shards=2)
    (tmp_path / "out" / "shard-000000-of-a-lost-attempt.planes").write_bytes(b"half a file")
    assert bit_planes.stored(manifest).count() == 20


@pytest.mark.parametrize("kind, top", [("<u2", 2 ** 16), ("<u4", 2 ** 32)])
def test_planes_of_blocks(kind, top):
    rng = np.random.default_rng(0)
    for n in (1, 7, 8, 64, 1000):
        ids = rng.integers(0, top, n).astype(kind)
        planes = bit_planes.to_planes(ids)
        assert len(planes) == 8 * ids.itemsize and (bit_planes.from_planes(planes, n, kind) == ids).all()
    sink = io.BytesIO()
    writer = bit_planes.PlaneWriter(sink, kind, block=100)
    ids = rng.integers(0, top, 1234).astype(kind)
    writer.add(ids[:1000], [1, None], np.array([999, 1]))
    writer.add(ids[1000:], [2, 3], np.array([234, 0]))
    assert writer.close() == len(sink.getvalue())
    reader = bit_planes.PlaneReader(sink)
    for start, count in ((0, 1234), (0, 0), (99, 2), (100, 100), (1233, 1), (1234, 0)):
        assert (reader.read(start, count) == ids[start:start + count]).all()
    assert [r[:3] for r in reader.documents()] == [(1, 0, 999), (None, 999, 1), (2, 1000, 234), (3, 1234, 0)]
    damaged = bytearray(sink.getvalue())
    damaged[3] ^= 1
    with pytest.raises(Exception):
        bit_planes.PlaneReader(io.BytesIO(bytes(damaged))).ids_of(0)


def brute_trie(rows):
    own, nodes = defaultdict(list), defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = (*own.get(c - int(np.fmod(c, 100)), [])[:h], *turns[h:])
        for d in range(len(path) + 1):
            nodes[path[:d]].append((c, d == len(path)))
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[:len(path)] == path]
        out.append((min(m[0] for m in members), len(path), min(m[0] for m in nodes[path[:-1]]) if path else None, len(members),
                    sum(len(p) == len(path) + 1 for p in under), sum(not any(q[:-1] == p for q in under if q) for p in under),
                    sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in under if p),
                    hashlib.sha256(",".join(str(c) for c, end in sorted(members) if end).encode()).hexdigest()))
    return Counter(out)


def conversations(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for c in [*range(0, 60), *range(200, 230), -5, -205, 340]:
        for t in range(int(rng.integers(1, 9))):
            rows.append((c, t if rng.random() > 0.1 else None, str(rng.choice(["u", "a"])) if rng.random() > 0.1 else None, ["hi", "ho", "", None, "é"][int(rng.integers(0, 5))]))
    rows += [(c, t, "u", f"same {t}") for c in range(500, 540) for t in range(3)]
    rows += [(600, t, "u", f"long {t % 4}") for t in range(50)] + [(601, t, "u", f"long {t % 4}") for t in range(47)]
    rows += [(700, 1, "u", "tie"), (700, 1, "u", "tie"), (700, 1, "a", "tie"), (None, 1, "u", "lost")]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard_turns": 30, "segment": 4, "width": 2, "chunk": 5}, {"shard_turns": 60, "segment": 16, "width": 3, "chunk": 5}])
def test_trie_against_brute_force(spark, sizes):
    rows = conversations(len(sizes))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, id string, depth int")
    got = trie.nodes(*trie.rebuilt(trie.numbered(trie.turn_ids(df))), **sizes)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert Counter(map(tuple, got.collect())) == brute_trie(rows)


def test_trie_of_no_or_turnless_conversations(spark):
    df = spark.createDataFrame([(1, 1, "u", "short")], "conv_id long, turn long, role string, text string")
    assert Counter(map(tuple, trie.conversation_trie(df).collect())) == brute_trie([(1, 1, "u", "short")])
    assert trie.conversation_trie(df.limit(0)).count() == 0
