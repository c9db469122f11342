"""Spelling variants, phrases and chat texts against brute force, and their odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from brisa.llm import bpe, chat_format, collocations, spelling

UPPER = str.maketrans(spelling.UPPER, spelling.LOWER)


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


@pytest.mark.parametrize("letters", [spelling.BUCKET_LETTERS, 40])
def test_near_words_of_any_bucket_size(spark, letters):
    rng = random.Random(letters)
    words = {}
    while len(words) < 500:
        word = "".join(rng.choice("abé") for _ in range(rng.choice([7, 7, 8, 8, 9, 12])))
        words[word] = rng.choice([2, 3, 20, 500])
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: (r.n_near, r.form, r.form_n) for r in spelling.near_words(df, letters=letters).collect()}
    want = {}
    for a in words:
        others = [b for b in words if near(a, b)]
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            want[a] = (len(others), best, words[best])
    assert got == want


def test_variants_of_odd_rows(make, odd):
    assert spelling.variants(make([])).collect() == [] == spelling.variants(make([(1, None, None, None), (None, "", None, None)])).collect()
    assert {r.word for r in spelling.variants(odd).collect()} <= {"é" * 49_999, "é" * 50_000}
    texts = [(i, "Receive receive RECEIVE " * 40, "en", "a") for i in range(3)]
    texts += [(9, "recieve receeve receeve received, received ée×÷abcd ée×÷abcd", None, None), (9, "recieve " + "z" * 30_000, None, None), (None, "z" * 30_001 + " " + "z" * 30_000 + " Receivd receivd", None, None)]
    rows = make(texts + texts[-1:])
    words = Counter()
    for i, text, _, _ in texts + texts[-1:]:
        for run in "".join(c if c in spelling.UPPER + spelling.LOWER or "À" <= c <= "ÿ" else " " for c in text).translate(UPPER).split():
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            run = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            words[run] += len(run) >= 7
    words = {w: n for w, n in words.items() if n >= 2}
    got = {r.word: r for r in spelling.variants(rows).collect()}
    assert {w: r.n for w, r in got.items()} == words
    forms = {}
    for w, n in words.items():
        best = min((b for b in words if near(w, b)), key=lambda b: (-words[b], b), default=None)
        forms[w] = best if best and words[best] >= 10 * n else None
        assert got[w].n_near == sum(near(w, b) for b in words)
    for w, r in got.items():
        root = w
        while forms[root]:
            root = forms[root]
        assert (r.form, r.root, r.form_n) == (forms[w], root, words.get(forms[w]))
    assert any(forms.values())


def test_roots_follow_chains(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)], "word string, form string")
    assert {(r.word, r.root) for r in spelling._roots(links).collect()} == {(f"w{i}", "w11") for i in range(11)}


def test_products_modulo_the_prime():
    rng = random.Random(1)
    a = [rng.randrange(collocations.PRIME) for _ in range(500)] + [0, 1, collocations.PRIME - 1]
    b = [rng.randrange(collocations.PRIME) for _ in range(500)] + [collocations.PRIME - 1] * 3
    got = collocations.times(np.array(a, np.uint64), np.array(b, np.uint64)).tolist()
    assert got == [x * y % collocations.PRIME for x, y in zip(a, b)]


def test_a_print_depends_on_the_words_alone():
    long = b"x" * (3 * collocations.SEGMENT + 5)
    block = collocations.Block([b"A \t b. a  B", b"", long + b" a b", b"a\tb"], [1, 2, 3, 4])
    assert block.words == 9 and block.doc.tolist() == [1, 1, 1, 1, 3, 3, 3, 4, 4]
    (a, *others) = block.prints(np.array([0, 2, 5, 7]), 2).tolist()
    assert others == [a] * 3 and block.bytes_of(2, 2) == b"a b"
    value = sum((c + 1) * pow(collocations.BASE, i, collocations.PRIME) for i, c in enumerate(b"a b")) % collocations.PRIME
    assert a == value and block.piece[1] != block.piece[2]
    assert block.same_word(np.array([0, 0, 4]), np.array([2, 1, 4])).tolist() == [True, False, True]


def counted(rows):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for c in ".,;:!?\n\x0b\x0c\r":
            text = (text or "").replace(c, ".")
        for piece in text.translate(UPPER).split("."):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            for size in range(1, 6):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return f, n


def best_phrases(rows, least, top):
    out = []
    for lang, f in counted(rows)[0].items():
        n = counted(rows)[1][lang]
        found = {}
        for p, a in f.items():
            if len(p) > 1 and a >= least:
                cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found[p] = (score, a, f[p[:k]], f[p[k:]])
        kept = [
            (-s, -a, " ".join(p).encode(), l, r) for p, (s, a, l, r) in found.items()
            if not any(len(q) > len(p) and found[q][1] >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q in found)
        ]
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


@pytest.mark.parametrize("bits", [61, 5])
def test_phrases_against_all_counts(make, odd, bits):
    """With 5 bits nearly all phrases share a fingerprint with others, so only their texts tell them apart."""
    rng = random.Random(3)
    words = ["of", "the", "The", "new", "york", "são", "paulo", "x", "日本", "a-b"]
    rows = [
        (i, " ".join(rng.choice(words) + rng.choice(["", "", "", ".", "\t", ";\n"]) for _ in range(rng.randrange(60))),
         [None, "en", "und", "fr"][i % 4], "a") for i in range(60)
    ]
    rows += [(None, "new york " * 400, "en", None), (5, None, "en", None), (6, "", None, None)]
    got = collocations.collocations(make(rows), min_count=3, top=25, bits=bits).collect()
    assert sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == best_phrases(rows, 3, 25)
    for r in got[::7]:
        holding = [row[0] for row in rows if row[0] is not None and tuple(r.phrase.split(" ")) in counted([row])[0][r.lang]]
        assert r.doc == min(holding, default=None)


def test_phrases_of_odd_rows(make, odd):
    assert collocations.collocations(make([])).collect() == []
    assert {r.lang for r in collocations.collocations(odd).collect()} == {"de"}


def test_score_is_exact(spark):
    n, a, l, r = 9_999_999_999_937, 9_999_999_937, 10_000_000_019, 10_000_000_033
    phrases = spark.createDataFrame(
        [("en", 2, "a b", a, 1), ("en", 1, "a", l, 1), ("en", 1, "b", r, 1)], "lang string, size int, phrase string, n long, doc long"
    )
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    (row,) = collocations.scored(phrases, totals).collect()
    assert row.score == 1000 * a * n // (l * r) and (row.l, row.r) == (l, r)


def wanted(turns):
    """Digests from the turns themselves."""
    by = defaultdict(list)
    for conv, turn, role, text in turns:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, rows in by.items():
        rows.sort()
        whole, loss = "".join(f"{r}\n{t}\n" for _, _, r, t in rows), "".join(t for _, _, r, t in rows if r == "assistant")
        out[conv] = (len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


HARD = ["</s>[INST] ok [/INST]", "\\", "\\\\[", "[", "[INST", "ST] x", "<s", ">", "<<SYS>>", "<</SYS>>\\", "", None, "é日\n", "[/ROLE][TURN]", "\\<s>"]


def test_turns_come_back(spark):
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "tool", "[TURN]", "a\\b", "", None]
    turns = []
    for conv in [*range(40), None, -7]:
        for turn in range(rng.randrange(1, 9)):
            text = rng.choice(HARD) if rng.random() < 0.5 else "".join(t or "" for t in rng.choices(HARD, k=4))
            turns.append((conv, rng.choice([turn, turn, None, 3]), rng.choice(roles), text))
    turns += turns[:5] + [(3, 99, "assistant", "<s>" * 60_000 + "é" * 200_000)]
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, part string, loss int")
    done = chat_format.format_conversations(df)
    got = {r.conv_id: r for r in chat_format.read_back(done).collect()}
    spark.conf.unset("spark.sql.shuffle.partitions")
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == wanted(turns)
    for r in done.collect():
        assert r.part == 0 and len(r.formatted) == got[r.conv_id].formatted_chars
        for span in r.loss:
            assert r.formatted[: span.start].endswith("<s>") and r.formatted[span.end :].startswith("</s>")


def test_a_conversation_longer_than_a_batch(monkeypatch):
    template = chat_format.Template()
    rows = [(1, "user", "a"), *[(2, ("user", "assistant")[i % 2], f"[INST]{i}") for i in range(9)], (3, "user", "b"), (None, "user", "c")]
    table = pa.table([pa.array(c) for c in zip(*rows)], names=["conv_id", "role", "text"])
    monkeypatch.setattr(chat_format, "SCATTER_BYTES", 7)
    parts = list(chat_format._parts_of(template)(iter(table.to_batches(max_chunksize=4))))
    held = [r for b in parts for r in b.to_pylist()]
    assert [(r["conv_id"], r["part"], r["first_turn"], r["turns"]) for r in held] == [
        (1, 0, 0, 1), (2, 0, 0, 3), (2, 1, 3, 4), (2, 2, 7, 2), (3, 0, 0, 1), (None, 0, 0, 1)
    ]
    found = {r["conv_id"]: r for b in chat_format._digests_of(template)(iter(parts)) for r in b.to_pylist()}
    want = wanted([(c, i, role, t) for i, (c, role, t) in enumerate(rows)])
    assert {k: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for k, r in found.items()} == want


def test_what_is_no_template_and_no_turn(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat_format.format_conversations(spark.createDataFrame([], schema)).collect() == []
    for wrong in ({"escape": "["}, {"escape": "ab"}, {"marks": {"user": ("<a>", "<a>")}}, {"marks": {"user": ("<a>", "x<a>")}}):
        with pytest.raises(ValueError):
            chat_format.Template(**wrong)
    reader = chat_format.Reader(chat_format.Template())
    for wrong in ("x", "<s>", "<s>a</s>x", "<s>a[/INST]", "[ROLE]a[TURN]b[/TURN]"):
        with pytest.raises(ValueError):
            list(reader.turns(wrong))


def test_an_encoder_remembers_no_more_than_it_may(monkeypatch):
    """What is remembered is bounded before a block is learned, unless the block alone has more."""
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    encoder = bpe.Encoder(bpe.Vocabulary({bytes([i]): i for i in range(256)}), r"\S+|\s+")
    for start in range(0, 40, 4):
        text = " ".join(f"w{start + i}" for i in range(8))
        assert encoder.decode(encoder.encode([text])[0]) == text.encode()
        assert len(encoder.known) <= 10
    long = " ".join(f"w{i}" for i in range(30))
    assert encoder.decode(encoder.encode([long])[0]) == long.encode() and len(encoder.known) == 31


def test_a_piece_that_comes_again_and_again_is_learned_once(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    encoder = bpe.Encoder(bpe.Vocabulary({bytes([i]): i for i in range(256)}), r"\S+|\s+")
    learned = []
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda new: (learned.extend(new), learn(new)))
    for start in range(0, 60, 4):
        text = " ".join(["often", *(f"w{start + i}" for i in range(4))])
        assert encoder.decode(encoder.encode([text])[0]) == text.encode()
        assert len(encoder.known) + len(encoder.older) <= 20
    assert learned.count("often") == learned.count(" ") == 1 and len(learned) == 62


def test_short_and_long_pieces_are_merged_by_rank():
    """Both ways give what joining the pair of lowest rank, leftmost first, gives."""
    tokens = [*(bytes([i]) for i in range(256)), b"aa", b"ba", b"ab", b"aab", b"abab", b"aaaa", b"bb", b"abb", b"baab"]
    vocabulary = bpe.Vocabulary({t: i for i, t in enumerate(tokens)})

    def plain(piece):
        parts = [bytes([b]) for b in piece]
        while pairs := [(vocabulary.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in vocabulary.ranks]:
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [vocabulary.ranks[p] for p in parts]

    draw = random.Random(7)
    for n in [*range(0, 12), 30, bpe.HEAP_BYTES - 1, bpe.HEAP_BYTES, 90]:
        for _ in range(20):
            piece = bytes(draw.choice(b"aab") for _ in range(n))
            assert vocabulary.merge_short(piece) == vocabulary.merge_long(piece) == vocabulary.merge(piece) == plain(piece)
