import numpy as np
import public_tokenizers

from ratingflow.llm import langid, queries
from tests.llm.helpers import SF, frame

NAMES = ["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "bab"]
PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(word, prob):
    """Sum over all segmentations, and the uses of each piece in them."""
    text, total, uses = "▁" + word, np.zeros(prob.shape[1]), np.zeros((9, prob.shape[1]))

    def walk(at, p, used):
        nonlocal total
        if at == len(text):
            total = total + p
            for u in used:
                uses[u] += p
            return
        for k, name in enumerate(NAMES):
            if text.startswith(name, at):
                walk(at + len(name), p * prob[k], [*used, k])
        if text[at] not in NAMES:
            walk(at + 1, p * prob[8], [*used, 8])
    walk(0, np.ones(prob.shape[1]), [])
    return total, uses


def test_forward_sums_all_segmentations():
    prob = langid.padded(np.random.default_rng(1).random((9, 2)) / 9)
    words = ["a", "b", "abab", "babab", "axb", "abbabaa", "zz"]
    pieces = langid.Pieces(NAMES)
    got = langid.word_scores(words, pieces, prob)
    assert np.allclose(got, [np.log(brute(w, prob)[0]) for w in words])
    langs, counts = np.array([0, 1, 0, 0, 1, 1, 0]), np.arange(7) + 1.0
    want = np.zeros((9, 2))
    for w, lang, n in zip(words, langs, counts):
        total, uses = brute(w, prob)
        want[:, lang] += n * uses[:, lang] / total[lang]
    assert np.allclose(langid.expected(words, langs, counts, pieces, prob), want)


def test_long_unseen_runs_in_a_large_language():
    """30 letters that no language has, after 1e10 pieces each of two: finite,
    alike in both, and as the plain sum for a word short enough for it."""
    pieces = langid.Pieces(NAMES)
    n = np.zeros((9, 2))
    n[:3] = [[6e9, 1e9], [1e9, 6e9], [3e9, 3e9]]
    for share in (0.0, 1e-6):
        prob = langid.padded(langid.smoothed(n, 0.01, share))
        run, short, mixed = langid.word_scores(["z" * 30, "zz", "a" + "z" * 29], pieces, prob)
        assert np.isfinite([run, short, mixed]).all() and abs(run[0] - run[1]) < 3
        # only the mark and the run's letters: a product
        assert np.allclose(run, np.log(prob[0]) + 30 * np.log(prob[8]))
        assert np.allclose(short, np.log(brute("zz", prob)[0]))
        uses = langid.expected(["z" * 30, "ab"], np.array([0, 1]), np.array([5, 2]), pieces, prob)
        assert np.allclose(uses[8], [150, 0]) and np.allclose(uses[0, 0], 5)
    assert langid.smoothed(n, 0.01, 1e-6)[8, 0] > 1e-8
    few = np.ones((9, 2))
    assert np.allclose(langid.smoothed(few, 0.01, 1e-6), 1.01 / 9.09)


def test_words_keep_their_marks(spark):
    hindi, decomposed = "\u0939\u093f\u0928\u094d\u0926\u0940", "cafe\u0301"
    assert langid.words_of(f"{hindi}, {decomposed.upper()}2x a_b") == [hindi, decomposed, "x", "a", "b"]
    assert langid.words_of("Ab1 " + "y" * 31) == ["ab", "y" * 30, "y"]
    rows = frame(spark, [(1, f"{hindi} {hindi}", "hi")]).selectExpr("lang", "text")
    assert [(r.lang, r.word, r.n) for r in langid.word_counts(rows).collect()] == [("hi", hindi, 2)]


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.op8_langid(spark, SF).collect()
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.99


def test_awkward_rows(spark):
    rows = [(i, "the house and the garden " * 3, "en") for i in range(20)]
    rows += [(100 + i, "das haus und der garten " * 3, "de") for i in range(20)]
    rows += [(200, None, "en"), (201, "", "de"), (202, "12 !? 34", "de"), (203, "the and", None),
             (204, "und " * 50_000, None), (204, "und das", None), (None, "the", None), (205, "x" * 500, None),
             (206, "日本", None), (207, "\u0301", None)]
    got = {}
    for r in langid.identify(frame(spark, rows), PATH).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert [got[i][0] for i in (200, 201, 202, 207)] == [("und", 0.0)] * 4
    assert got[203][0][0] == "en" and [p for p, _ in got[204]] == ["de", "de"] and got[None][0][0] == "en"
    assert got[205][0][0] in ("de", "en") and got[206][0][0] in ("de", "en")
    unlabelled = frame(spark, [(1, "text", None)])
    assert [(r.lang_pred, r.score) for r in langid.identify(unlabelled, PATH).collect()] == [("und", 0.0)]
    assert langid.identify(frame(spark, []), PATH).collect() == []


def slow_model(rows, names, rounds=2, floor=0.01, share=1e-6):
    """Piece probabilities by dictionaries, word by word: {lang: {piece: p}}."""
    rare = object()
    langs = sorted({lang for lang, _ in rows})
    prob = {lang: {k: 1 / (len(names) + 1) for k in [*names, rare]} for lang in langs}
    for _ in range(rounds):
        uses = {lang: dict.fromkeys([*names, rare], 0.0) for lang in langs}
        for lang, text in rows:
            for word in langid.words_of(text):
                edges = slow_edges(word, names, rare)
                total, ends = slow_sum(word, edges, prob[lang])
                back = [0.0] * (len(word) + 1) + [1.0]
                for a, b, k in sorted(edges, key=lambda e: -e[0]):
                    back[a] += prob[lang][k] * back[b]
                for a, b, k in edges:
                    uses[lang][k] += ends[a] * prob[lang][k] * back[b] / total
        for lang in langs:
            more = max(floor, share * sum(uses[lang].values()) / (len(names) + 1))
            whole = sum(uses[lang].values()) + more * (len(names) + 1)
            prob[lang] = {k: (n + more) / whole for k, n in uses[lang].items()}
    return prob, rare


def slow_edges(word, names, rare):
    text = "▁" + word
    out = [(a, b, text[a:b]) for a in range(len(text)) for b in range(a + 1, len(text) + 1) if text[a:b] in names]
    return out + [(a, a + 1, rare) for a, c in enumerate(text) if c not in names]


def slow_sum(word, edges, prob):
    ends = [1.0] + [0.0] * (len(word) + 1)
    for a, b, k in sorted(edges, key=lambda e: e[1]):
        ends[b] += ends[a] * prob[k]
    return ends[-1], ends


def test_predictions_equal_plain_training_and_scoring(spark):
    """The whole way, from labelled documents to scores, without arrays."""
    import zlib
    some = [("de", "Der Hund läuft über die Straße nach Hause."), ("fr", "Le chien court dans la rue à côté."),
            ("en", "The dog runs over the street to its house."), ("en", "A house is near the street, it's big."),
            ("de", "Das Haus ist groß und der Hund klein."), ("fr", "La maison est grande et le chien petit."),
            (None, "un chien"), ("en", None), ("fr", "12 34 !"), ("de", "日本 ok")]
    docs = [(i, t, lang) for i, (lang, t) in enumerate(some * 3)]
    asked = [(100, "the dog of the house"), (101, "der große hund"), (102, "la petite maison"), (103, "ox"), (104, "日本語 é")]
    rows = frame(spark, docs + [(i, t, None) for i, t in asked])
    got = {r.doc_id: r for r in langid.identify(rows, PATH).collect()}
    names = set(langid.vocabulary_pieces(PATH))
    learn = [(lang, t) for i, t, lang in docs if lang and t and zlib.crc32(str(i).encode()) % 4 != 2]
    prob, rare = slow_model(learn, names)
    for i, t in [*asked, *((i, t) for i, t, _ in docs if t)]:
        words = langid.words_of(t)
        if not words:
            assert got[i].lang_pred == "und"
            continue
        logs = {lang: sum(np.log(slow_sum(w, slow_edges(w, names, rare), p)[0]) for w in words) for lang, p in prob.items()}
        best = max(logs, key=logs.get)
        assert got[i].lang_pred == best
        assert abs(got[i].score - 1 / sum(np.exp(x - logs[best]) for x in logs.values())) < 1e-6
