"""Similarity join, exact groups and lines against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from brisa.llm import components, line_dedup, radix_dedup, shingle_join
from tests.llm.conftest import ODD

SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def split(text):
    for c in SPACE[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def shingle_set(text):
    words = split(lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """doc_id -> (shingles, component) by comparing all pairs."""
    sets = [shingle_set(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return Counter((r[0], len(sets[i]), min(least[find(i)], default=None) if sets[i] else r[0]) for i, r in enumerate(rows))


def edited(rng, words, n, vocabulary):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return " ".join(words)


@pytest.mark.parametrize("length,edits,pool", [(9, 1, 3), (30, 3, 4), (150, 6, 30), (150, 5, 2000)])
def test_near_copies_of_one_text_lose_no_link(make, length, edits, pool):
    """Copies around the threshold: far more share a signature than are similar."""
    rng = random.Random(length * edits + pool)
    vocabulary = [f"w{i}" for i in range(pool)]
    base = [f"b{i}" for i in range(length)]
    rows = [(i, edited(rng, base, rng.randrange(edits + 1), vocabulary), "en", "a") for i in range(220)]
    rows += [(1000 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40))), "en", "a") for i in range(40)]
    rows += [(2000 + i, rows[i][1].upper().replace(" ", "\n "), "en", "a") for i in range(20)]
    found = shingle_join.near_duplicates(make(rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows)


def test_different_sizes_and_shared_passage(make):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for i in range(60):
        own = [f"d{i}_{j}" for j in range(rng.randrange(20, 300))]
        rows.append((2 * i, " ".join(own), "en", "a"))
        more = own + [f"t{i}_{j}" for j in range(len(own) // rng.choice([4, 5, 6, 8]))]
        rows.append((2 * i + 1, " ".join(more), "en", "a"))
        rows.append((1000 + i, " ".join(own) + " " + passage, "en", "a"))
    found = shingle_join.near_duplicates(make(rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows)


def test_join_of_odd_rows(odd):
    found = shingle_join.near_duplicates(odd).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(ODD)


def test_words_made_to_collide(make):
    """A Thue-Morse word and its complement are one to every polynomial modulo a power of two."""
    word = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"x y z {word}", "en", "a"), (2, f"x y z {other}", "en", "a"), (3, f"{word} " * 9, "en", "a"), (4, f"{other} " * 9, "en", "a")]
    found = shingle_join.near_duplicates(make(rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows)


def test_pairs_are_compared_by_words():
    """The last word on a pair is that of its words, not of hashes."""
    rng = random.Random(3)
    for _ in range(300):
        x, y = (" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 40))) for _ in range(2))
        if x != y:
            a, b = shingle_join.numbered_shingles(x.encode(), y.encode())
            p, q = shingle_set(x), shingle_set(y)
            assert shingle_join.similar(a, b) == (100 * len(p & q) >= 80 * len(p | q))


def test_identity_of_a_text_hashes_no_word(spark):
    """Three passes read every text; only one of them needs its words one by one."""
    shingle_join._hash_of.clear()
    node = shingle_join.identity(b"One two\n three ")
    assert node == shingle_join.identity(b" one  TWO three") != shingle_join.identity(b"one twothree")
    assert shingle_join.identity(b" \n") is None and shingle_join.identity(b"") is None
    assert not shingle_join._hash_of
    nodes = [node, bytes(16), bytes(15) + b"\x01", b"\xff" * 16, b"\x00\x80" * 8]
    rows = spark.createDataFrame([shingle_join.halves(n) for n in nodes], "high long, low long")
    assert [bytes(r[0]) for r in rows.select(shingle_join.node_of("high", "low")).collect()] == nodes


def test_text_of_more_than_one_block(make):
    words = [f"w{i}" for i in range(330_000)]  # 2.2 MB
    rows = [(1, " ".join(words), "en", "a"), (2, " ".join(words[:300_000]), "en", "a"), (3, " ".join(words[:100_000]), "en", "a")]
    found = shingle_join.near_duplicates(make(rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows)


def test_bound_of_every_band():
    """A set takes part in all bands that hold sets similar to it, and its own is the last."""
    for size in [*range(1, 400), 5000, 123_456]:
        bands = shingle_join.bands_of(size)
        lasts = [shingle_join.band(b)[0] for b in bands]
        assert bands[-1] <= size <= lasts[-1]
        for other in range(-(-size * 4 // 5), size + 1) if size < 400 else ():
            own = [b for b, last in zip(bands, lasts, strict=True) if b <= other <= last]
            assert len(own) == 1
            assert (size + other) // 9 <= min(shingle_join.band(own[0])[1], shingle_join.most_apart(size, own[0]))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 70)] + [(200, 200 + i) for i in range(1, 90)] + [(500, 500)]
    edges += [(rng.randrange(600, 700), rng.randrange(600, 700)) for _ in range(60)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert found == {x: find(x) for x in parent}


def exact(rows):
    groups = defaultdict(list)
    for k, (d, t, *_) in enumerate(rows):
        groups["".join(c for c in t or "" if c not in SPACE)].append((-len(t or ""), d is None, d or 0, k))
    out = Counter()
    for text, members in groups.items():
        best = min(members)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for m in members:
            out[(rows[m[3]][0], rows[best[3]][0], len(members), m == best, sha)] += 1
    return out


def test_exact_groups(make):
    rng = random.Random(3)
    texts = ["x" * 32, "x" * 33, "x" * 32 + " ", "x " * 5000, "x " * 5001, "x " * 40_000 + "y", "x " * 40_000 + "z", "z"]
    rows = [(i, rng.choice(texts), "en", "a") for i in range(200)] + ODD
    found = radix_dedup.exact_groups(make(rows)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found) == exact(rows)


def test_the_very_row_that_was_chosen_stays(make):
    texts = ["a b c", "a  b   c", "ab c", "a b  c", "abc"]
    for shift in range(len(texts)):
        rows = [(k, t, "en", "a") for k in (1, None) for t in texts[shift:] + texts[:shift]]
        kept = radix_dedup.keep_one(make(rows).repartition(3)).collect()
        assert [(r.doc_id, r.text) for r in kept] == [(1, "a  b   c")]


def test_keep_one_row_of_each_group(make, odd):
    kept = radix_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(d or -1 for (d, _, _, k, _), n in exact(ODD).items() if k)


def lines(rows, least):
    texts = [(t or "").split("\n") for _, t, *_ in rows]
    count = Counter(k for x in texts for k in {lower(line).strip(SPACE) for line in x})
    out = Counter()
    for (d, *_), x in zip(rows, texts, strict=True):
        kept = [line for line in x if not (k := lower(line).strip(SPACE)) or count[k] < least]
        out[(d, len(x), len(x) - len(kept), "\n".join(kept))] += 1
    return out


def test_lines(make):
    rng = random.Random(4)
    pool = [f"line {i}" for i in range(60)] + [" Line 1\t", "LINE 2", "", "  ", "é", "É"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(6))), "en", "a") for i in range(150)] + ODD
    for least in (1, 10, 12):
        found = line_dedup.drop_frequent(make(rows), least).collect()
        assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found) == lines(rows, least)


def test_empty_tables(make):
    none = make([])
    assert shingle_join.near_duplicates(none).collect() == []
    assert radix_dedup.exact_groups(none).collect() == []
    assert line_dedup.drop_frequent(none).collect() == []


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    for size in (1, 40, 400, 3000):
        x = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        for changed in {0, 1, size // 9, size // 3, size}:
            y = np.unique(np.concatenate([x[changed:], rng.integers(0, 2**64, changed, dtype=np.uint64)]))
            apart = int(np.bitwise_count(shingle_join.parities(x) ^ shingle_join.parities(y)).sum())
            assert apart <= len(np.setxor1d(x, y))
            if size == 400 and changed == size // 3:
                assert 9 * apart > len(x) + len(y)


def test_records_stand_once_in_each_bucket():
    packer = shingle_join.RecordPacker(3)
    sketch = shingle_join.parities(np.arange(5, dtype=np.uint64))
    sent = {}
    for me in (7, 8):
        found = [(np.arange(me, me + 40, dtype=np.uint64) << np.uint64(20), role) for role in (shingle_join.INDEX, shingle_join.PROBE)]
        packer.add((me, 1, 5, 4, 2, sketch), found)
        sent[me] = {(int(s), role) for signatures, role in found for s in signatures}
    back = defaultdict(set)
    for row in packer.flush().to_pylist():
        records = np.frombuffer(row["records"], dtype=shingle_join.SECOND)
        assert len(set(records["id"].tolist())) == len(records)
        for s, place in zip(shingle_join.from_six(row["signatures"]).tolist(), np.frombuffer(row["places"], dtype="<u4").tolist(), strict=True):
            back[int(records["id"][place >> 1])].add((s, place & 1))
    assert back == sent
    assert packer.n == 0 and not packer.records
