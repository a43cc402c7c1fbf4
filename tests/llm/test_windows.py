import hashlib
import random
import re
from collections import Counter

import pytest

from ratingflow.llm import queries, substring_dedup, suffix_dedup, windows
from tests.llm.helpers import SF, frame, texts, words


def reference_bytes(rows, length):
    """doc_id -> (kept, n_removed, n_spans), strings counted one by one."""
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[p:p + length] for p in range(len(b) - length + 1))
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone, end = bytearray(len(b)), 0
        for p in range(len(b) - length + 1):
            if count[b[p:p + length]] > 1:
                gone[max(p, end):p + length] = b"\1" * (p + length - max(p, end))
                end = p + length
        out[i] = (bytes(x for x, g in zip(b, gone) if not g), sum(gone), len(re.findall(b"\1+", bytes(gone))))
    return out


def reference_words(rows, length):
    """doc_id -> (kept, n_words, n_removed); rows in the order of their ids."""
    seen, out = set(), {}
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            window = tuple(w[p:p + length])
            if window in seen:
                gone[p:p + length] = [True] * length
            seen.add(window)
        out[i] = (b" ".join(x for x, g in zip(w, gone) if not g).decode(), len(w), sum(gone))
    return out


def test_bytes_query_equals_brute_force(spark):
    got = {r.doc_id: (r.kept_sha256, r.n_bytes, r.n_removed, r.n_spans)
           for r in queries.op6_suffix_dedup(spark, SF).collect()}
    rows = texts(spark)
    want = reference_bytes(rows, 200)
    assert got == {i: (hashlib.sha256(want[i][0]).hexdigest(), len(t.encode()), *want[i][1:]) for i, t in rows}


def test_words_query_equals_brute_force(spark):
    got = {r.doc_id: (r.kept_sha256, r.n_words, r.n_removed)
           for r in queries.op7_substring_dedup(spark, SF).collect()}
    want = reference_words(texts(spark), 20)
    assert got == {i: (hashlib.sha256(k.encode()).hexdigest(), n, g) for i, (k, n, g) in want.items()}


def copied(seed, alphabet, sizes, n):
    """Texts that copy stretches of each other, with few different symbols."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(*sizes)))
        for _ in range(rng.randrange(0, 4)):
            if out:
                source = rng.choice(out)[1]
                a = rng.randrange(0, len(source) + 1)
                part = source[a:a + rng.randrange(1, 160)]
                at = rng.randrange(0, len(t) + 1)
                t = t[:at] + part + t[at:]
        out.append((i, t))
    return out


@pytest.mark.parametrize("seed,alphabet", [(1, "ab"), (2, "abcdé\n "), (3, "a"), (4, "abcdefghijklmnop ")])
def test_bytes_with_few_symbols(spark, seed, alphabet):
    rows = copied(seed, alphabet, (0, 300), 60)
    got = {r.doc_id: (bytes(r.kept), r.n_removed, r.n_spans)
           for r in suffix_dedup.dedup(frame(spark, rows), length=40, gram=10).collect()}
    assert got == reference_bytes(rows, 40)


@pytest.mark.parametrize("seed,alphabet", [(5, "a b"), (6, "ab  c\t"), (7, "a ")])
def test_words_with_few_symbols(spark, seed, alphabet):
    rows = copied(seed, alphabet, (0, 400), 60)
    got = {r.doc_id: (r.kept, r.n_words, r.n_removed)
           for r in substring_dedup.dedup(frame(spark, rows), length=8).collect()}
    assert got == reference_words(rows, 8)


def test_lengths_between_two_and_three_grams(spark):
    rng = random.Random(10)
    part = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    rows = []
    for i in range(0, 60, 2):
        shared = part(150)
        rows += [(i, part(90) + shared + part(90)), (i + 1, part(70) + shared + part(80))]
    got = {r.doc_id: (bytes(r.kept), r.n_removed, r.n_spans)
           for r in suffix_dedup.dedup(frame(spark, rows), length=150).collect()}
    assert got == reference_bytes(rows, 150) and all(v[1] >= 150 for v in got.values())
    assert suffix_dedup.widest_gram(200) == 64
    for gram, length in ((64, 190), (64, 128), (10, 28)):
        with pytest.raises(ValueError):
            suffix_dedup.dedup(frame(spark, rows), length=length, gram=gram)


def test_slices_of_long_texts_agree(spark, monkeypatch):
    rows = copied(8, "abc ", (0, 900), 40)
    monkeypatch.setattr(windows, "SLICE", 64)
    bytes_ = {r.doc_id: (bytes(r.kept), r.n_removed, r.n_spans)
              for r in suffix_dedup.dedup(frame(spark, rows), length=40, gram=10).collect()}
    assert bytes_ == reference_bytes(rows, 40)
    words_ = {r.doc_id: (r.kept, r.n_words, r.n_removed)
              for r in substring_dedup.dedup(frame(spark, rows), length=8).collect()}
    assert words_ == reference_words(rows, 8)


def test_awkward_rows(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(None, passage), (1, None), (2, ""), (3, passage), (3, passage), (4, "x " + passage), (5, passage + "\xa0y"),
            (6, "z " * 100_000)]
    docs = frame(spark, rows)
    got = {r.doc_id: (r.kept, r.n_words, r.n_removed) for r in substring_dedup.dedup(docs).collect()}
    assert got[None] == (passage, 30, 0)            # a null id is the smallest
    assert got[1] == got[2] == ("", 0, 0)
    assert got[3] == ("", 30, 30) and got[4] == ("x", 31, 30)
    assert got[5] == ("w29\xa0y", 30, 29)           # a no-break space is part of a word
    assert got[6] == ("z", 100_000, 99_999)         # every window but the first starts earlier
    kept = substring_dedup.rewrite(docs)
    assert kept.columns == docs.columns
    left = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    assert left == {None: (passage, len(passage)), 1: (None, None), 2: ("", 0), 4: ("x", 1),
                    5: ("w29\xa0y", 5), 6: ("z", 1)}
    found = {r.doc_id: (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans)
             for r in suffix_dedup.dedup(docs, length=40, gram=10).collect()}
    assert found[1] == found[2] == (b"", 0, 0, 0)
    assert found[3][0] == b"" and found[6][0] == b"" and found[6][3] == 1


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    rows = [(i % 3 or None, t) for i, t in copied(9, "abc ", (0, 300), 60)]
    rows += [(None, rows[0][1]), (None, None), (7, "one row")]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    docs = frame(spark, rows)
    numbered = [(n, t) for n, (_, t) in enumerate(rows)]
    full = lambda found: sorted(map(str, found))
    want = reference_bytes(numbered, 40)
    assert full((r.doc_id, bytes(r.kept), r.n_removed, r.n_spans) for r in suffix_dedup.dedup(docs, length=40, gram=10)
                .collect()) == full((i, *want[n]) for n, (i, _) in enumerate(rows))
    want = reference_words(numbered, 8)
    assert full((r.doc_id, r.kept, r.n_words, r.n_removed) for r in substring_dedup.dedup(docs, length=8).collect()) \
        == full((i, *want[n]) for n, (i, _) in enumerate(rows))
    kept = substring_dedup.rewrite(docs, length=8)
    assert kept.columns == docs.columns
    assert full((r.doc_id, r.text) for r in kept.collect()) == full(
        (i, want[n][0] if want[n][2] else t) for n, (i, t) in enumerate(rows) if not want[n][1] or want[n][2] < want[n][1])


def test_empty_table(spark):
    assert suffix_dedup.dedup(frame(spark, [])).collect() == []
    assert substring_dedup.dedup(frame(spark, [])).collect() == []
    assert substring_dedup.rewrite(frame(spark, [])).collect() == []


def test_sliding_min_is_the_minimum_of_each_window():
    import numpy as np
    x = np.random.default_rng(2).integers(0, 50, 300).astype(np.uint64)
    for width in (1, 2, 3, 16, 17, 137, 300):
        assert windows.sliding_min(x, width).tolist() == [int(x[i:i + width].min()) for i in range(300 - width + 1)]


def thue_morse(letters, n=1024):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_words_built_to_collide_are_told_apart(spark):
    """A hash modulo 2^64 takes the Thue-Morse word for its complement."""
    tail = " " + " ".join(f"w{i}" for i in range(19))
    rows = [(1, thue_morse("ab") + tail), (2, thue_morse("ba") + tail)]
    docs = frame(spark, rows)
    assert {r.doc_id: r.n_removed for r in substring_dedup.dedup(docs).collect()} == {1: 0, 2: 0}
    assert {r.doc_id: r.text for r in substring_dedup.rewrite(docs).collect()} == dict(rows)
    strings = [(1, thue_morse("ab", 4096) + "x" * 300), (2, thue_morse("ba", 4096) + "y" * 300)]
    got = {r.doc_id: (bytes(r.kept), r.n_removed, r.n_spans) for r in suffix_dedup.dedup(frame(spark, strings)).collect()}
    assert got == reference_bytes(strings, 200)


def test_names_are_polynomials(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(4)
    points = windows.new_points()
    names = windows.Names(points, 2000)
    data = rng.integers(0, 256, 2000).astype(np.uint8)
    prefix = names.prefix(suffix_dedup._BYTE[data])
    for a, b in [(0, 2000), (5, 5), (1999, 2000), *map(sorted, rng.integers(0, 2001, (20, 2)).tolist())]:
        want = [sum((int(x) + 1) * pow(p, i, windows.PRIME) for i, x in enumerate(data[a:b])) % windows.PRIME for p in points]
        assert int(names.of(prefix, np.array([a]), np.array([b]))[0]) == want[0] << 31 | want[1]
    whole = int(names.of(prefix, np.array([0]), np.array([2000]))[0])
    monkeypatch.setattr(substring_dedup, "PIECE", 300)
    assert int(substring_dedup.long_name(data, names)) == whole


def test_places_of_a_core_cover_it():
    for size, gram in ((183, 64), (20, 5), (8, 2), (37, 10), (100, 1), (257, 64), (64, 64)):
        places = windows.core_places(0, size, gram)
        assert len(places) & (len(places) - 1) == 0 and len(places) > 1
        assert {i for p in places for i in range(p, p + gram)} == set(range(size))


@pytest.mark.parametrize("length,gram", [(257, 64), (200, 10), (41, 3)])
def test_several_doublings(spark, length, gram):
    rows = [(i, t * 3) for i, t in copied(11, "abcdefgh", (0, 300), 40)]
    got = {r.doc_id: (bytes(r.kept), r.n_removed, r.n_spans)
           for r in suffix_dedup.dedup(frame(spark, rows), length=length, gram=gram).collect()}
    assert got == reference_bytes(rows, length)
