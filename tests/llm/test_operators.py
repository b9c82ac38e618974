"""The operators against brute force on small tables, with nulls, empty texts, repeated rows, empty tables and clashing columns."""

import hashlib
import itertools
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallymart.llm import (catalog, language_model, lattice, license_scan, line_dedup, mixing, packing, quality_model, quality_rules, simhash,
                           url_blocks)
from tallymart.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, h1 string, kept string"
WORDS = "the cat sat on a mat and ate some fish while it rained outside all day long in town".split()


def documents(spark, rows):
    """rows of (doc_id, text), or (doc_id, text, source); the other columns clash with names the operators use."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, 1, "x", "y") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd():
    """Copies, near copies, shared lines, nulls, blanks, a repeated row and a long text."""
    rng = np.random.default_rng(0)
    base = [" ".join(rng.choice(WORDS, 80)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, base[0]) for i in range(5)] + [(200, base[1] + " end"), (201, base[1] + " stop")]
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "Ünïcödé ß 𝄞 word"), (None, base[2]), (5, base[5]), (304, "one two")]
    rows += [(400 + i, f"A line that many documents share.\n{base[i]}\n  a LINE that many documents share. ") for i in range(4)]
    return rows + [(500, " ".join(rng.choice(WORDS, 30_000)))]


def united(ids, pairs):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_brute_force(spark, odd):
    got = simhash.near_duplicates(documents(spark, odd)).collect()
    prints = [slow_fingerprint(t) for _, t in odd]
    near = [(i, j) for i, j in itertools.combinations(range(len(odd)), 2) if (prints[i] ^ prints[j]).bit_count() <= 2]
    groups = united(range(len(odd)), near)
    least = {r: min((odd[i][0] for i in groups if groups[i] == r and odd[i][0] is not None), default=None) for r in set(groups.values())}
    want = Counter((odd[i][0], f"{prints[i]:016x}", least[groups[i]]) for i in range(len(odd)))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def five_words(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def changed(rng, words, n):
    out = list(words)
    for at in rng.choice(len(out), n, replace=False):
        out[at] = f"new{rng.integers(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("cell_rows", [7, 500_000])
def test_near_copies_against_brute_force(spark, odd, cell_rows, monkeypatch):
    """Every pair with 0.8 or more of its five-word shingles in common is in one group, and no group has strangers."""
    monkeypatch.setattr(simhash, "PRINT_CELL_ROWS", cell_rows)
    if cell_rows == 7:
        monkeypatch.setattr(simhash, "HUB_LINKS", 2)
        monkeypatch.setattr(simhash, "BROADCAST_ENDS", 0)
    rng = np.random.default_rng(4)
    own = [[f"w{rng.integers(5000)}" for _ in range(rng.integers(60, 400))] for _ in range(60)]
    texts = [t for w in own for t in (" ".join(w), changed(rng, w, max(1, len(w) // 60)), changed(rng, w, len(w) // 5))]
    texts += [" ".join(own[0][:40] + w) for w in own[1:10]]  # a shared passage alone makes no copy
    rows = odd + [(1000 + i, t) for i, t in enumerate(texts)]
    docs = documents(spark, rows)
    got = simhash.near_copies(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    group = {r["doc_id"]: r["component_id"] for r in got}
    sets = [(i, five_words(t)) for i, t in rows if i is not None]
    share = {(i, j): len(a & b) / len(a | b) for (i, a), (j, b) in itertools.combinations(sets, 2) if a & b}
    near = [p for p, s in share.items() if s >= 0.8]
    assert len(near) > 60 and all(group[i] == group[j] for i, j in near)
    related = united([i for i, _ in sets], near)
    assert all(related[i] == related[group[i]] for i, _ in sets)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    stays = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in stays if i is not None) == sorted({c for c in group.values() if c is not None})
    assert simhash.near_copies(docs.limit(0)).count() == 0


def test_shingles_of_all_texts_are_counted(spark, odd):
    """More texts than a sample of 20,000 has; each shingle counts once a text, wherever the text lies."""
    texts = [t for _, t in odd if t] + [f"a b c d e f{i % 9}" for i in range(21_000)]
    want = Counter(c for t in texts for c in simhash.counter_of(simhash.distinct_shingles(t.encode(), 5)).tolist())
    got = simhash.shingle_counts(spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "text binary").repartition(5), 5)
    assert {int(k): int(got[k]) for k in np.flatnonzero(got)} == want
    assert not simhash.shingle_counts(spark.createDataFrame([], "text binary"), 5).any()


@pytest.mark.parametrize("bound", [simhash.BROADCAST_KEYS, 0])
def test_one_of_each_decides_by_row(spark, monkeypatch, bound):
    monkeypatch.setattr(simhash, "BROADCAST_KEYS", bound)
    a, b, c = (" ".join(f"{k}{i}" for i in range(50)) for k in "xyz")
    rows = [(3, a), (7, a), (7, b), (None, c), (None, c), (None, a), (9, "one"), (9, "one"), (9, "two"), (None, None), (4, ""), (5, None)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key_ string, root int")
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert Counter((r[0], r[1] or "") for r in kept.collect()) == Counter([(3, a), (7, b), (None, c), (9, "one"), (9, "two"), (4, "")])


def test_one_of_each_leaves_no_shuffle_files(spark):
    """Files that stay until the driver collects its garbage filled the disk: dozens of short queries with a file for each of hundreds of tasks."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {p for d in folders for p in Path(d).rglob("shuffle_*")}
    df = documents(spark, [(k, " ".join(f"w{(k // 2) * 50 + i}" for i in range(50))) for k in range(40)])
    before = files()
    kept = simhash.one_of_each(df)
    assert len(files() - before) <= 10
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(0, 40, 2))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def of_share(rng, n, common):
    """Two texts with n + 4 words each that have exactly ``common`` of their n five-word shingles in common."""
    words = [f"w{rng.integers(10**9)}" for _ in range(n + 4)]
    return " ".join(words), " ".join(words[:common + 4] + [f"x{rng.integers(10**9)}" for _ in range(n - common)])


def test_a_rejected_pair_takes_no_near_copy_with_it(spark):
    """Families of one template in which A-B is near and A-C and C-B are not, in many random arrangements: only the near pairs are joined."""
    rng, rows, want = np.random.default_rng(8), [], {}
    for k in range(60):
        words = [f"w{rng.integers(10**9)}" for _ in range(304)]
        family = [list(words) for _ in range(6)]
        for j, own in enumerate(family):  # runs of changed words at the end: 30 + 30 of 300 changed shingles are 0.82, 35 + 35 are 0.79
            size, at = (30, 10 * j) if j < 2 else (int(rng.integers(36, 60)), 10 * j)
            own[304 - size:] = [f"y{k}.{j}.{i}.{at}" for i in range(size)]
        rows += [(10 * k + j, " ".join(own)) for j, own in enumerate(family)]
    sets = [(i, five_words(t)) for i, t in rows]
    near = [(i, j) for (i, a), (j, b) in itertools.combinations(sets, 2) if i // 10 == j // 10 and len(a & b) / len(a | b) >= 0.8]
    assert len(near) >= 60
    want = united([i for i, _ in rows], near)
    assert {r["doc_id"]: r["component_id"] for r in simhash.near_copies(documents(spark, rows)).collect()} == want


@pytest.mark.parametrize("others", [0, 3000])
def test_every_pair_at_the_limit_is_found_beside_any_number_of_others(spark, others):
    """Pairs at exactly 0.8 and just under it, in texts that mostly consist of passages that many texts hold, short and long ones."""
    rng = np.random.default_rng(9)
    passage = " ".join(f"p{i}" for i in range(24))
    rows, want = [], {}
    for k in range(200):
        n, near = int(rng.integers(2, 60)) * 9, k % 2 == 0  # c of n in common: c / (2n - c) is 0.8 for c = 8n / 9
        a, b = of_share(rng, n, n // 9 * 8 - (0 if near else 1))
        rows += [(2 * k, a), (2 * k + 1, b)]
        want |= {2 * k: 2 * k, 2 * k + 1: 2 * k + (not near)}
    for k in range(100):  # 20 shingles of the passage, 4 across its end, then the text's own
        a, b = of_share(rng, 3, 3 if k % 2 else 0)
        rows += [(1000 + 2 * k, f"{passage} {a} end"), (1001 + 2 * k, f"{passage} {b} stop")]
    rows += [(10_000 + i, " ".join(f"o{v}" for v in rng.integers(0, 10**6, 30))) for i in range(others)]
    sets = [(i, five_words(t)) for i, t in rows if i < 10_000]
    near = [(i, j) for (i, a), (j, b) in itertools.combinations(sets, 2) if len(a & b) >= 0.8 * len(a | b) - 1e-9]
    assert sum(i < 1000 for i, _ in near) == 100
    groups = united([i for i, _ in rows], near)
    assert all(groups[i] == w for i, w in want.items())
    assert {r["doc_id"]: r["component_id"] for r in simhash.near_copies(documents(spark, rows)).collect()} == groups


def test_long_texts_are_compared_by_all_their_shingles(spark):
    """Of 9,000 shingles 8,000 in common are 0.8 exactly, 7,999 are less; no sample can tell them apart."""
    rng = np.random.default_rng(10)
    texts = [of_share(rng, 9_000, 8_000 - k % 2) for k in range(24)]
    rows = [(2 * k + i, t) for k, pair in enumerate(texts) for i, t in enumerate(pair)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(documents(spark, rows)).collect()}
    assert got == {2 * k + i: 2 * k + i * (k % 2) for k in range(24) for i in (0, 1)}


def test_a_large_group_of_near_copies_is_one_group(spark):
    rng = np.random.default_rng(6)
    base = [f"w{rng.integers(5000)}" for _ in range(300)]
    rows = [(i, changed(rng, base, 2)) for i in range(3000)]
    assert {r["component_id"] for r in simhash.near_copies(documents(spark, rows)).collect()} == {0}


@pytest.mark.parametrize("cell_rows", [8, 4096])
def test_trie_join_finds_all_links_also_when_cells_are_cut(spark, cell_rows):
    rng = np.random.default_rng(1)
    prints = [int(v) for v in rng.integers(0, 2**63, 40, dtype=np.uint64)]
    for p in prints[:10]:
        prints += [p ^ int(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in (1, 2, 2, 3)]
    prints += [prints[0] ^ (1 << b) for b in range(64)]
    prints = sorted(set(prints))
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    found = {tuple(np.uint64(np.int64(v)) for v in r) for r in simhash.links(df, 2, cell_rows).collect()}
    near = [(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 2]
    assert united(prints, [(int(a), int(b)) for a, b in found]) == united(prints, near)
    assert all((int(a) ^ int(b)).bit_count() <= 64 for a, b in found)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 60), (60, 70), (70, 50), (80, 80)] + [(100, i) for i in range(101, 140)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*edges, (None, 5)], "a long, b long")).collect()}
    assert got == united({v for a, b in edges if a != b for v in (a, b)}, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_dedup_against_brute_force(spark, odd):
    blanks = " \t\n\v\f\r"
    upper = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    key = lambda line: line.strip(blanks).translate(upper)
    held = [({key(x) for x in (t or "").split("\n") if len(key(x)) >= 20}, i) for i, t in odd]
    docs, last = Counter(k for keys, _ in held for k in keys), {}
    for keys, i in held:
        for k in keys:
            last[k] = max(last.get(k, -1), -1 if i is None else i)
    want = Counter()
    for i, t in odd:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (docs[key(x)] >= 3 and (-1 if i is None else i) < last[key(x)])]
        want[i, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    for batches in (1, 5):
        got = line_dedup.drop_lines(documents(spark, odd), batches=batches)
        assert Counter(tuple(r) for r in got.collect()) == want
    out = line_dedup.deduplicated(documents(spark, odd))
    assert out.columns == documents(spark, odd).columns
    assert Counter((r["doc_id"], r["text"] or "") for r in out.collect()) == Counter((i, t) for (i, t, _, _), n in want.items() for _ in range(n))


def test_packing_round_trip(spark, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = [(i if i is not None else -1, t, None if k == 3 else f"s{k % 3}") for k, (i, t) in enumerate(odd)]
    odd = [(n, t, s) for n, (_, t, s) in enumerate(odd)] + [(900, "x<|endoftext|>y THE it's \0 J̌"), (901, None)]
    for shares in (None, {"s0": 0.5, "s1": 0.3}):
        pieces = packing.pack(documents(spark, odd), path, window=64, shares=shares).collect()
        by_doc, by_window = {}, {}
        for p in pieces:
            by_doc.setdefault(p["doc_id"], []).append(p)
            by_window.setdefault(p["sequence_id"], []).append(p)
        for n, t, *_ in odd:
            ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
            parts = sorted(by_doc[n], key=lambda p: p["start"])
            assert np.concatenate([np.frombuffer(p["ids"], "<u4") for p in parts]).tolist() == ids
            assert [p["start"] for p in parts] == np.cumsum([0, *[p["length"] for p in parts]])[:-1].tolist()
            assert {p["doc_tokens"] for p in parts} == {len(ids)}
        assert sorted(by_window) == list(range(len(by_window)))
        for w, parts in by_window.items():
            parts = sorted(parts, key=lambda p: p["offset"])
            assert [p["offset"] for p in parts] == np.cumsum([0, *[p["length"] for p in parts]])[:-1].tolist()
            assert sum(p["length"] for p in parts) == 64 or w == max(by_window)
    first = packing.digest(spark.createDataFrame([(1, "s", 0, 2, 2, 0, 0, np.array([7, 2], "<u4").tobytes())],
                           "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")).first()
    assert first["ids_crc32"] == packing.crc_of([7, 2]) == zlib.crc32(b"\7\0\0\0\2\0\0\0")


def test_windows_hold_the_target_mixture():
    totals = [40_000, 8_000, 2_000]
    plan = packing.epochs(totals, [0.6, 0.3, 0.1])
    at = np.arange(0, 15_000, 100)
    served = np.stack([packing.served(plan, q, at) for q in range(3)])
    assert (served.sum(0) == at).all()
    assert np.abs(served - np.array([[0.6], [0.3], [0.1]]) * at).max() < 2.5  # deficits stay under a token or two, wherever one starts


def test_windows_hold_the_mixture_of_any_number_of_sources(spark):
    """60 sources, and 40 with a given share: every stretch of windows has each source's part to within two chunks, and no token is lost."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = np.random.default_rng(11)
    rows = [(60 * k + s, " ".join(rng.choice(WORDS, int(rng.integers(20, 40 + 10 * (s % 5))))), f"s{s:02}") for k in range(30) for s in range(60)]
    rows.append((5000, " ".join(rng.choice(WORDS, 1500)), "s59"))
    for shares in (None, {f"s{s:02}": 1.0 for s in range(40)}):
        pieces = packing.pack(documents(spark, rows), path, window=1024, shares=shares).select(
            "doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset").collect()
        by_doc, held, totals = {}, Counter(), Counter()
        for p in pieces:
            by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], p["length"]))
            held[p["sequence_id"], p["source"]] += p["length"]
            totals[p["source"]] += p["length"]
        assert len(by_doc) == len(rows)
        for (_, n), parts in by_doc.items():
            parts.sort()
            assert [a for a, _ in parts] == np.cumsum([0, *[k for _, k in parts]])[:-1].tolist() and sum(k for _, k in parts) == n
        windows, part = max(w for w, _ in held), {s: n / sum(totals.values()) for s, n in totals.items()}
        if shares:
            windows, part = int(0.9 * 40 * min(totals[s] for s in shares) / 1024), {s: s in shares and 1 / 40 for s in totals}
        for s in totals:
            served = np.cumsum([held[w, s] for w in range(windows)])
            assert np.abs(served - part[s] * 1024 * np.arange(1, windows + 1)).max() < 128


def test_lattice_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 20))
    near = np.concatenate([base, base[:20] + rng.normal(size=(20, 20)) * 0.15, base[:10] * 3, base[:8]])
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(near)] + [
        (900, None, 1), (901, [0.0] * 20, 1), (902, [1.0, None] + [0.0] * 18, 1), (903, [float("nan")] * 20, 0), (904, [1.0] * 20, None), (905, [], 1), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, links string")
    good = [(i, np.array(v), k) for i, v, k in rows if v and k is not None and None not in v and np.isfinite(v).all() and any(v)]
    pairs = [(a, b) for (a, x, k), (b, y, m) in itertools.combinations(good, 2)
             if k == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98]
    count, groups = Counter(v for p in pairs for v in p), united([r[0] for r in rows], pairs)
    want = {(r[0], count[r[0]], groups[r[0]], groups[r[0]] == r[0]) for r in rows}
    assert len(pairs) > 20
    for cell_rows in (3, 1024):
        assert {tuple(r) for r in lattice.near_vectors(df, cell_rows=cell_rows).collect()} == want
    assert lattice.near_vectors(df.limit(0)).count() == 0


def test_lattice_with_repeated_ids_and_text_labels(spark):
    rows = [(5, [1.0, 0.0], "a"), (5, [0.0, 1.0], "a"), (6, [1.0, 0.001], "a"), (7, [1.0, 0.0], "b"), (None, [0.0, 1.0], "a"), (None, [3.0, 3.0], "c"), (8, [1.0, 1.0], "c"), (9, [-1.0, 0.0], "a")]
    got = lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")).collect()
    assert Counter((r[0], r[1], r[2]) for r in got) == Counter([(5, 1, 5), (5, 1, 5), (6, 1, 5), (7, 0, 7), (None, 1, 5), (None, 1, 8), (8, 1, 8), (9, 0, 9)])


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(200, 8))
    own = lattice.decode(points) / 2
    others = own[:, None, :] + lattice.NEIGHBOURS[None]
    assert (((points - own) ** 2).sum(1)[:, None] <= ((points[:, None] - others) ** 2).sum(2) + 1e-9).all()


def test_language_model_counts_and_normalises(spark, odd):
    got = language_model.scored(documents(spark, odd), held_words=8).collect()
    training = [(t or "").encode().lower().split() + [b""] for i, t in odd if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    c = Counter(w for t in training for w in t)
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in odd:
        tokens = (t or "").encode().lower().split() + [b""]
        base = sum(np.log10((c[w] + 1) / (n + v + 1)) for w in tokens)
        want[i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, len(tokens), sum(w in c for w in tokens), n, round(base, 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    table = language_model.train(np.array([5, 70_000, 900_000]), np.array([10, 20, 30]), steps=20)
    np.testing.assert_allclose((10.0 ** table.astype(float)).sum(2), 1, rtol=1e-4)
    assert language_model.scored(documents(spark, odd).limit(0)).count() == 0


def test_language_model_beats_the_base_on_held_out_texts(spark, sf_dir):
    r = catalog.op3_language_model(spark, sf_dir).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_classifier_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = catalog.op4_quality_model(spark, d).where("held_out").join(labels, "doc_id").select("quality", "predicted", "score").collect()
    assert sum(r["quality"] == r["predicted"] for r in got) >= 0.9 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_classifier_without_labels_and_on_odd_texts(spark, odd):
    docs, none = documents(spark, odd), spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality_model.judged(docs, none).collect()} == {0.5}
    kept = quality_model.accepted(docs, none)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert quality_model.judged(docs.limit(0), none).count() == 0


def test_license_notices(spark):
    notices = [("MIT", "Released under the MIT License."), ("GPL-3.0", "This program is licensed under the GNU General Public License, version 3."),
               ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
               ("CC-BY-4.0", "This document is licensed under CC BY 4.0."), (None, "She has a driving licence."), (None, "Licensed under CC BY-NC 5.0.")]
    rows = [(i, f"Some text.\n{line}\nMore.") for i, (_, line) in enumerate(notices)] + [(90, None), (91, ""), (None, "x\n" + notices[0][1]), (0, "Released under the MIT License")]
    got = Counter((r["doc_id"], r["line"], r["license"]) for r in license_scan.scanned(documents(spark, rows)).collect())
    assert got == Counter([(i, 1, name) for i, (name, _) in enumerate(notices) if name] + [(None, 1, "MIT"), (0, 0, "MIT")])


def test_license_notices_over_several_lines(spark):
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU {} Public License as published by\n"
           "# the Free Software Foundation, either version {} of the License, or\n# (at your option) any later version.")
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Keep this."
    mit = ('Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\n'
           "in the Software without restriction, including")
    texts = [
        ("Licensed under the Apache License,\nVersion 2.0", {(0, "Apache-2.0")}), (gpl.format("General", 3), {(1, "GPL-3.0")}), (gpl.format("Lesser General", 2.1), {(1, "LGPL-2.1")}),
        ("x\n// SPDX-License-Identifier: MIT", {(1, "MIT")}), ("# SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0 OR Zlib)", {(0, "GPL-2.0"), (0, "Zlib")}),
        (f"MIT License\n\n{mit}", {(2, "MIT")}), (bsd, {(0, "BSD-2-Clause")}), (f"{bsd}\n\nNeither name may be used to endorse or\npromote products.\n\n{bsd}", {(0, "BSD-3-Clause"), (8, "BSD-2-Clause")}),
        ("Licensed under the MIT License or the Apache License, Version 2.0.", {(0, "MIT"), (0, "Apache-2.0")}), ("Permission is denied.\nA licence\n\nVersion 2.0", set()),
        ("Licensed under the Apache\n\nLicense, Version 2.0", set()), ("MIT holds the copyright.", set()),
    ]
    found = license_scan.scanned(documents(spark, [(i, t) for i, (t, _) in enumerate(texts)])).collect()
    assert Counter((r["doc_id"], r["line"], r["license"]) for r in found) == Counter((i, *n) for i, (_, names) in enumerate(texts) for n in names)
    assert {r["text"] for r in found if r["doc_id"] == 0} == {texts[0][0]}


def test_license_titles_short_names_and_denials(spark):
    texts = [
        ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007", {(0, "GPL-3.0")}), ("Licensed under the GNU General Public License v3.0", {(0, "GPL-3.0")}),
        ("It is GNU GPLv3 software", {(0, "GPL-3.0")}), ("Creative Commons Attribution 4.0 International", {(0, "CC-BY-4.0")}),
        ("Creative Commons Attribution-ShareAlike 4.0 International", {(0, "CC-BY-SA-4.0")}), ("ISC License\n\nText.", {(0, "ISC")}),
        ("We have an ISC License for that.", set()), ("Not licensed under the MIT License", set()), ("It isn't released under the MIT License.", set()),
        ("No longer released under the MIT License but\nlicensed under CC BY 4.0.", {(1, "CC-BY-4.0")}), ("GNU Lesser General Public License version 3", {(0, "LGPL-3.0")}),
    ]
    found = license_scan.scanned(documents(spark, [(i, t) for i, (t, _) in enumerate(texts)])).collect()
    assert Counter((r["doc_id"], r["line"], r["license"]) for r in found) == Counter((i, *n) for i, (_, names) in enumerate(texts) for n in names)


def test_license_compression_proposes_every_notice():
    """Notices anywhere in long blocks, at their ends too: as many as when every template is compared with the whole block."""
    class Exhaustive(license_scan.Scanner):
        def proposed(self, own):
            return {(0, len(own)): list(range(len(self.words)))}

    rng, known, slow = np.random.default_rng(4), license_scan.Scanner(), Exhaustive()
    plain, total = ["the", "of", "licence", "work", "copyright", "version", "public", "general", "gnu", "x1"] + [f"v{i}ord" for i in range(60)], 0
    for _ in range(120):
        lines = []
        for _ in range(int(rng.integers(1, 12))):
            lines.append(" ".join(rng.choice(plain, int(rng.integers(1, 40)))))
            if rng.random() < 0.5:
                said = license_scan.TEMPLATES[int(rng.integers(len(license_scan.TEMPLATES)))][1].split()
                cut = int(rng.integers(len(said)))
                lines += [" ".join(part) for part in (said[:cut], said[cut:]) if part]
        block = tuple(line.encode() for line in lines)
        want = slow.found(block)
        assert known.found(block) == want
        total += len(want)
    assert total > 200


def test_blocks_follow_links_to_aliases(spark):
    link = '<html><link rel="canonical" href="{}"></html>'
    pages = [
        (1, "http://a.net/x", link.format("https://www.Example.org/es/9")), (2, "http://b.net/y?q", '<LINK href="http://a.net/x" rel=canonical>'),
        (3, "http://example.org/es/9", None), (4, "http://c.net/", "<meta http-equiv=refresh content='0; url=/z'>"), (5, "http://c.net/z", link.format("http://d.com/fr/1")),
        (6, "http://e.net/", link.format("http://d.com/de/1")), (7, "http://e.net/", None), (8, None, None), (9, "nothing", "x"), (3, "http://EXAMPLE.org/es/9#t", None),
        (10, "http://x.org/", None), (11, "http://f.net/p/q", link.format("r")), (12, "http://f.net/p/r", None),
        (13, "not a url", link.format("http://example.org/es/x")), (14, "also malformed", None), (15, "http://g.net/", link.format("mailto:someone")), (16, "http:///p", link.format("http://com/de/")),
    ]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, verdict string")
    moved = spark.createDataFrame([("http://f.net/p/r", "http://com/de/x"), ("http://c.net/z", "http://com/de/y")], "url string, target string")
    got = [(r["page_id"], r["rule"], r["verdict"]) for r in url_blocks.judged_pages(df, moved).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, None, "block"), (2, None, "block"), (3, "example.org/es/", "block"), (3, "example.org/es/", "block"), (4, None, "allow"), (5, None, "allow"),
        (6, None, "block"), (7, None, "block"), (8, None, "allow"), (9, None, "allow"), (10, "org/", "allow"), (11, None, "block"), (12, None, "block"),
        (13, None, "allow"), (14, None, "allow"), (15, None, "allow"), (16, None, "allow")], key=repr)
    assert url_blocks.judged_pages(df.limit(0)).count() == 0


def test_rules_on_odd_texts(spark, odd):
    rows = odd + [(600, "a b c d e f a b c d e"), (601, "x " * 40), (602, "# $ % & | < >  * #" * 20)]
    got = {(r["doc_id"], r["n_words"]): r for r in quality_rules.judged(documents(spark, rows)).collect()}
    for i, t in rows:
        words = (t or "").encode().split()
        windows = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
        covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1 for j in range(5)}
        r = got[i, len(words)]
        assert (r["n_repeat_words"], r["word_chars"]) == (len(covered), sum(len(w.decode()) for w in words))
        assert r["base_failed"] == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (r["kept"] and r["base_failed"])
    assert quality_rules.judged(documents(spark, rows)).where("kept").count() > 0
    assert quality_rules.judged(documents(spark, [])).count() == 0


def test_mixing_meets_the_margins(spark):
    rows = [(i, "w " * (5 + i % 50), f"s{i % 5 if i % 2 else 0}") for i in range(600)] + [(700, None), (None, ""), (701, "x", None)]
    out = mixing.mixed(documents(spark, rows)).cache()
    total = out.agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0]
    shares = {r["source"]: r["w"] / total for r in out.groupBy("source").agg(F.sum(F.col("tokens") * F.col("probability")).alias("w")).collect()}
    tokens = Counter()
    for r in out.collect():
        tokens[r["source"]] += r["tokens"]
    want = {s: t ** 0.8 for s, t in tokens.items()}
    assert all(abs(shares[s] - want[s] / sum(want.values())) < 1e-6 for s in want)
    targets = {"source": spark.createDataFrame([("s0", 0.25), ("s1", 0.75)], "value string, share double")}
    given = mixing.mixed(documents(spark, rows), targets)
    weights = {r["source"]: r["w"] for r in given.groupBy("source").agg(F.sum(F.col("tokens") * F.col("probability")).alias("w")).collect()}
    assert abs(weights["s1"] / weights["s0"] - 3) < 1e-6 and weights["s2"] == 0
    kept = mixing.sample(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in out.where("kept").collect())
    assert mixing.mixed(documents(spark, [])).count() == 0
    assert mixing.gaps(documents(spark, [])).count() == 0


def test_mixing_tells_when_targets_cannot_be_met(spark):
    """Each source has a language of its own, so both cannot have shares of their own; sources and languages that can are met."""
    df = spark.createDataFrame([(i, "w " * 9, f"s{i % 3}", f"l{i % 3}") for i in range(90)], "doc_id long, text string, source string, lang string")
    given = lambda name, shares: spark.createDataFrame([(f"{name}{i}", s) for i, s in enumerate(shares)], "value string, share double")
    against = {"source": given("s", [.6, .3, .1]), "lang": given("l", [.2, .3, .5])}
    with pytest.raises(ValueError, match="cannot be met"):
        mixing.mixed(df, against, strict=True)
    with pytest.raises(ValueError, match="cannot be met"):
        mixing.sample(df, against, strict=True)
    gap = {(r["margin"], r["value"]): (r["target"], r["share"], r["gap"]) for r in mixing.gaps(df, against).collect()}
    assert gap["lang", "l0"] == pytest.approx((.2, .2, 0)) and gap["source", "s0"] == pytest.approx((.6, .2, -2 / 3))
    assert mixing.mixed(df, against).count() == 90
    along = {"source": given("s", [.6, .3, .1, .5]), "lang": given("l", [.6, .3, .1])}
    assert all(abs(r["gap"]) < 1e-9 for r in mixing.gaps(df, along).collect())
    assert mixing.mixed(df, along, strict=True).where("kept").count() == mixing.sample(df, along, strict=True).count()


@pytest.mark.parametrize("small", [0, 50_000])
def test_raking_against_numpy(spark, small, monkeypatch):
    """The same cells raked by numpy, over few cells and as if there were many."""
    monkeypatch.setattr(mixing, "SMALL_CELLS", small)
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(3, 400)), f"s{int(rng.integers(4)) ** 2}", f"l{rng.integers(3)}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = mixing.mixed(df, strict=True).collect()
    cells = Counter()
    for r in out:
        cells[r["source"], r["lang"], r["topic"]] += r["tokens"]
    keys, weight = list(cells), np.array(list(cells.values()), float)
    tokens, index = weight.copy(), [np.unique([k[m] for k in keys], return_inverse=True)[1] for m in range(3)]
    for _ in range(200):
        for at in index:
            want = np.bincount(at, tokens) ** 0.8
            weight = weight * (want / want.sum() / np.bincount(at, weight))[at]
    want = dict(zip(keys, weight / tokens / (weight / tokens).max()))
    assert all(abs(r["probability"] - want[r["source"], r["lang"], r["topic"]]) < 1e-8 for r in out)


def test_kept_text_hash(spark):
    text = "a\nb"
    got = line_dedup.drop_lines(documents(spark, [(1, text)])).select(F.sha2(F.col("kept").cast("binary"), 256)).first()[0]
    assert got == hashlib.sha256(text.encode()).hexdigest()
