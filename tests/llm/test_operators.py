"""Each operator against a plain version, over rows with every odd case; empty tables; clashing columns."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import tracemalloc
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chronosift.llm import langid, line_dedup, mixing, packing, pii, pitman_yor, simhash, token_counts, topk, winnow
from chronosift.llm.bpe import library, ranks_agree
from chronosift.llm.common import crc_mod

P = pytest.importorskip("public_tokenizers")


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


# ---- 1


def test_language_id(docs, rows):
    model = langid.train(docs, crc_mod("doc_id", 4) != 2)
    out = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    truth = {r[0]: r for r in rows}
    held = [i for i in truth if crc(i, 4) == 2 and truth[i][2] and truth[i][1] and len(truth[i][1].split()) > 8]
    assert held and sum(out[i].lang_pred == truth[i][2] for i in held) >= 0.9 * len(held)
    for i in (100, 101, 102, 103):
        assert (out[i].lang_pred, out[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in out.values())
    assert langid.predict(docs, model).count() == len(rows)


def plain_grams(text):
    """Letters in lower case, all else a gap; the distinct n-grams of n = 1 to 3 as strings."""
    s = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    return {s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}


def plain_kernel(s, t):
    a, b = plain_grams(s), plain_grams(t)
    return len(a & b) / math.sqrt(len(a) * len(b))


def test_language_scores_are_kernel_ridge(spark):
    """With every training text a landmark, the Nystroem map is exact: scores are those of plain weighted kernel ridge regression."""
    rows = [(i, t, x) for i, (t, x) in enumerate([("abc abd", "a"), ("xyz xyw", "x"), ("abd bcd", "a"), ("xyy yzz", "x"), ("ab dd", "a"), ("中文 文字", "zh"), ("文本 中文", "zh")])]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), n_landmarks=300)
    texts, langs = [t for _, t, _ in rows], [x for _, _, x in rows]
    classes = sorted(set(langs))
    k = np.array([[plain_kernel(s, t) for t in texts] for s in texts])
    y = np.array([[1.0 if x == c else -1.0 for c in classes] for x in langs])
    shrink = np.diag([1e-2 * langs.count(x) / len(classes) for x in langs])  # ridge * n / classes over the weight n / n_l
    alpha = np.linalg.solve(k + shrink, y)
    new = ["abcd", "xyzw words", "文", "zzz 12 qqq", "", "123", "a" * 5000 + " bcd"]
    got = langid.predict(spark.createDataFrame([(i, t) for i, t in enumerate(new)], "doc_id long, text string"), model)
    for r in got.collect():
        if not any(c.isalpha() for c in new[r.doc_id]):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        margin = np.array([plain_kernel(new[r.doc_id], t) for t in texts]) @ alpha
        assert r.lang_pred == classes[int(margin.argmax())]
        assert abs(r.score - min(1, max(0, (margin.max() + 1) / 2))) < 2e-3


def test_junk_lowers_the_score(docs):
    model = langid.train(docs, F.lit(True))
    own = "the cat sat on the mat and it was there"
    rng = np.random.default_rng(0)
    junk = " ".join("".join(rng.choice([*"qzxjkvwбгд"], 7)) for _ in range(200))
    assert model.score([own + " " + junk])[1][0] < model.score([own])[1][0] - 0.05


def test_repeated_rows_crowd_out_no_language(spark):
    rng = np.random.default_rng(3)
    words = {"en": "the of and to in is that".split(), "fr": "le la les des et que dans".split(), "zh": "中文 文字 我们 他们 这个 语言".split(), "ja": "これは それは ひらがな です ます".split()}
    say = lambda x, n: " ".join(rng.choice(words[x], n))
    rows = [(7, say("fr", 30), "fr")] * 3000 + [(100 + i, say(x, 30), x) for i in range(400) for x in ("en", "zh", "ja")]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), each=50)
    assert model.classes == ["en", "fr", "ja", "zh"]
    assert model.score([say(x, 12) for x in ("en", "fr", "ja", "zh")])[0] == ["en", "fr", "ja", "zh"]


def test_language_of_nothing(none):
    model = langid.train(none, F.lit(True))
    assert langid.predict(none, model).count() == 0


def test_keep_claimed_keeps_columns(clashing):
    model = langid.train(clashing, F.lit(True))
    out = langid.keep_claimed(clashing, model)
    assert out.columns == clashing.columns
    kept = {r.doc_id for r in out.collect()}
    assert not kept & {100, 101, 102, 103} and {7, 104, 200} <= kept


def test_long_text_that_no_language_claims_goes(spark, docs):
    model = langid.train(docs, F.lit(True))
    own = spark.createDataFrame([(1, "бвгд жзкл мнпр стфх " * 40), (2, "бвгд жзкл"), (3, "the of and with that was " * 20)], "doc_id long, text string")
    assert sorted(r.doc_id for r in langid.keep_claimed(own, model).collect()) == [2, 3]


# ---- 2


def test_raking_meets_the_marginals():
    cells = [(s, t) for s in "abc" for t in "xyz"]
    w = [1.0, 5, 2, 8, 1, 1, 9, 3, 4]
    want = {"x": 0.5, "y": 0.3, "z": 0.2}
    fitted = mixing.rake(cells, w, [None, want], 60)
    for t, share in want.items():
        assert abs(sum(f for f, c in zip(fitted, cells, strict=True) if c[1] == t) / sum(w) - share) < 1e-9
    prob = mixing.calibrate(np.array(w), fitted, 0.4)
    assert abs((prob * w).sum() - 0.4 * sum(w)) < 1e-9 and prob.max() <= 1


def test_mixing_paths_agree(docs, rows):
    a = mixing.production_mix(docs)
    words = mixing.n_words(F.col("text"))
    topics = docs.withColumn("topic", mixing.topic_of(F.col("text"), words))
    b = mixing.mix(topics, {"source": None, "lang": mixing.LANGS, "topic": mixing.TOPICS}, words, most_cells=0)
    key = lambda df: sorted((r.doc_id, r.n_tokens, round(r.prob, 6)) for r in df.collect())
    assert key(a) == key(b)
    assert a.count() == len(rows)
    for r in a.collect():
        u = int(hashlib.md5(f"{r.doc_id}:{mixing.SEED}".encode()).hexdigest()[:8], 16) / 2**32
        assert r.sampled == (u < r.prob)
        assert r.n_tokens == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))


def test_mixing_odd_tables(none, clashing):
    assert mixing.production_mix(none).count() == 0
    out = mixing.production_mix(clashing)
    assert out.count() == clashing.count() and "_source" in out.columns


# ---- 3


def plain_lines(texts, least):
    key = lambda x: ascii_lower(x.strip(" \t\n\x0b\x0c\r"))
    seen = collections.Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) and seen[key(x)] >= least)]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("least", [2, 10])
def test_line_dedup(docs, rows, least):
    out = line_dedup.drop_frequent_lines(docs, min_docs=least, fanout=2)
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect())
    assert got == sorted((r[0], *x) for r, x in zip(rows, plain_lines([r[1] for r in rows], least), strict=True))


def test_line_runs_compact(spark):
    runs = line_dedup.LineRuns(spark, min_docs=3, fanout=2)
    for batch in ([(1, 1, 1), (2, 2, 1)], [(1, 1, 2)], [(2, 2, 1), (3, 3, 9)], [(2, 2, 1), (1, 1, 5)], [(4, 4, 2)]):
        runs.add(spark.createDataFrame(batch, line_dedup.RUN))
    assert len(runs.levels) == 3 and sorted(map(tuple, runs.frequent().collect())) == [(1, 1), (2, 2), (3, 3)]
    held = sorted((r.k1, r.n_docs) for r in runs._read(runs.runs()).collect())
    assert held == [(1, 1), (2, 1), (3, 9), (4, 2)]  # each line in one run, with the count of the batch that brought it
    runs.drop()
    assert not runs.runs() and runs.frequent().count() == 0


def test_line_dedup_merges_batches_with_runs(spark, docs, monkeypatch):
    """In the path of the query every batch but the first is merge-anti-joined with runs that hold lines."""
    seen = []

    class Watched(line_dedup.LineRuns):
        def _write(self, counts):
            plan = counts._jdf.queryExecution().executedPlan().toString()
            seen.append((sum(self._read([n]).count() for n in self.runs()), "LeftAnti" in plan and "SortMergeJoin" in plan, len(self.levels)))
            return super()._write(counts)

    monkeypatch.setattr(line_dedup, "LineRuns", Watched)
    line_dedup.drop_frequent_lines(docs).count()
    joined = [held for held, anti, _ in seen if anti]
    assert len(joined) == line_dedup.number_of_batches(0) - 1 > 3 and all(joined)
    assert max(levels for _, _, levels in seen) > 1


def test_line_dedup_is_linear_in_lines(spark):
    many = "\n".join(f"line {j}" if j % 2 else f"own {j}" for j in range(60_000))
    own = spark.createDataFrame([(i, many if i < 2 else "\n".join(f"line {j}" for j in range(60_000))) for i in range(4)], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.drop_frequent_lines(own, min_docs=3).collect()}
    assert got == {0: (60_000, 30_000), 1: (60_000, 30_000), 2: (60_000, 30_000), 3: (60_000, 30_000)}


def test_line_dedup_odd_tables(none, clashing):
    assert line_dedup.drop_frequent_lines(none).count() == 0
    out = line_dedup.drop_frequent_lines(clashing)
    assert {"_rk", "_drop", "key"} <= set(out.columns) and out.count() == clashing.count()


# ---- 4


def plain_spans(t):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


TEXTS = ["a.b+c@ex-1.co.uk, x@y", "1.2.3.4.5.6.7.8 999.1.1.1", "4111 1111-1111 1111 and 4111111111111112", "+1 (555) 123-4567 170.10.10.1", "4111111111111111 4012888888881881", "mail bob [at] example [dot] com or call 555-123-4567", "é🙂 q@w.e"]


def test_base_spans_are_the_patterns():
    rng = np.random.default_rng(0)
    marks = [*"aB12..-@+() \né", "4111111111111111", "ex.com", "+1 555 1234567", "10.0.0.1", "٣"]
    for t in [*TEXTS, *["".join(rng.choice(marks, rng.integers(0, 40))) for _ in range(3000)]]:
        assert sorted(pii.candidates(t)[0]) == plain_spans(t)


def test_pii(spark, docs, rows):
    own = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TEXTS * 5)], "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    got = {r.doc_id: r for r in pii.find_spans(own).collect()}
    for i, t in enumerate(TEXTS):
        assert [(s.kind, s.start, s.stop) for s in got[1000 + i].base] == plain_spans(t)
    # a number that ran into its neighbour is added; a number that fails its checksum is not
    assert (3, 0, 17) in [(s.kind, s.start, s.stop) for s in got[1003].added]
    assert len([s for s in got[1004].added if s.kind == 2]) == 2
    assert not [s for s in got[1002].added if s.start > 20]
    assert all(not got[r[0]].added for r in rows if r[0] < 60)


def plain_added(texts, threshold=0.9):
    """Every candidate that overlaps no base span, judged by the classifier trained on the votes' likelihoods; all by plain loops."""
    base = [plain_spans(t) for t in texts]
    more = []
    for t, own in zip(texts, base, strict=True):
        more.append([c for c in sorted(pii.candidates(t)[1]) if not any(c[1] < b and a < c[2] for _, a, b in own)])
    every = [(t, c, True) for t, own in zip(texts, base, strict=True) for c in own] + [(t, c, False) for t, own in zip(texts, more, strict=True) for c in own]
    counts = collections.Counter((c[0], pii.votes(t, *c, strict)) for t, c, strict in every)
    likely = pii.reliabilities(counts)
    seen = collections.defaultdict(lambda: (0, 0.0))
    for t, c, strict in every:
        f, p = pii.features(t, *c), round(likely[c[0], pii.votes(t, *c, strict)], 6)
        seen[f] = (seen[f][0] + 1, seen[f][1] + p)
    sure = pii.classifier(seen)
    return [[c for c in own if sure([pii.features(t, *c)])[0] >= threshold] for t, own in zip(texts, more, strict=True)]


def test_added_spans_by_brute_force(spark):
    rng = np.random.default_rng(8)
    parts = ["call 555-123-4567", "mail bob [at] example [dot] com", "4111111111111111 4012888888881881", "order 4111111111111112", "+1 (555) 123-4567 170.10.10.1", "ip 10.0.0.1", "300.1.1.1", "a@b.com", "version 1.2.3.4", "card 5500-0000-0000-0004", "1234 5678 9012 3456", "tel +44 20 7946 0958", "words only", "(555) 222-3333 fax"]
    texts = [" ".join(rng.choice(parts, rng.integers(1, 6))) for _ in range(300)]
    got = {r.doc_id: r for r in pii.find_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = plain_added(texts)
    for i, t in enumerate(texts):
        assert [(s.kind, s.start, s.stop) for s in got[i].base] == plain_spans(t)
        assert [(s.kind, s.start, s.stop) for s in got[i].added] == want[i]
    assert any(want) and not any(t[a:b] in ("4111111111111112", "300.1.1.1") for t, own in zip(texts, want, strict=True) for _, a, b in own)


def test_classifier_generalises():
    """Features never seen together are judged by their parts."""
    def code(*values):
        out = 0
        for x, n in zip(values, pii.FEATURES, strict=True):
            out = out * n + x
        return out

    seen = {code(2, 2, 4, 0, ok, side, 1, w): (50, 50.0 * ok) for ok in (0, 1) for side in (0, 1) for w in (0, 3, 5)}
    sure = pii.classifier(seen)
    assert sure([code(2, 2, 4, 0, 1, 2, 1, 9)])[0] > 0.9 and sure([code(2, 2, 4, 0, 0, 2, 1, 9)])[0] < 0.1


def test_pii_long_texts_are_linear(spark):
    pii.candidates("1" * 300_000 + "a" * 300_000 + "@" + " +" + "1 " * 300_000)
    many = " ".join(f"+1 555 {i % 900 + 100} {i:04d}, 555-123-{i % 10_000:04d} a{i}@b.com;" for i in range(40_000))  # nearly 2 MB
    r = pii.find_spans(spark.createDataFrame([(1, many)], "doc_id long, text string")).first()
    assert len(r.base) == 80_000


def test_clear_is_the_overlap_test():
    rng = np.random.default_rng(9)
    for _ in range(300):
        spans = [(0, int(a), int(a + n)) for a, n in zip(rng.integers(0, 60, 8), rng.integers(1, 9, 8), strict=True)]
        taken = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 60, 4), rng.integers(1, 12, 4), strict=True)]
        assert pii.clear(spans, taken) == sorted(c for c in spans if not any(c[1] < b and a < c[2] for a, b in taken))


def test_em_finds_the_bad_labeler():
    counts = {(0, (1, 1, 0)): 80, (0, (0, -1, 0)): 80, (0, (1, 1, 1)): 10, (0, (0, -1, 1)): 10}
    likely = pii.reliabilities(counts)
    assert likely[0, (1, 1, 0)] > 0.9 and likely[0, (0, -1, 1)] < 0.1


def test_pii_holds_little(spark):
    """Batches are bounded, and a text with very many spans costs bytes, not objects, for each."""
    session = spark.newSession()
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    session.conf.set(key, "64m")
    text = "1.2.3.4 " * 50_000
    r = pii.find_spans(session.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(r.base) == 50_000 and int(session.conf.get(key)) == 4 << 20
    found = pii.candidates(text)[0]
    tracemalloc.start()
    spans = pii.Spans()
    spans.add(text, found, True)
    lists = spans.lists()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(lists) == 1 and lists.to_pylist()[0] == [x.asDict() for x in r.base] and most < 100 * 50_000


def test_pii_chosen_spans():
    spans = pii.Spans()
    assert pii.chosen(spans.lists(), []).to_pylist() == []
    for text in ("1.2.3.4 a@b.com", "", "+1 202 555 0100 and 1.2.3.4", "none", "4111 1111 1111 1111"):
        spans.add(text, pii.candidates(text)[0], True)
    lists = spans.lists()
    assert [len(x) for x in lists.to_pylist()] == [2, 0, 2, 0, 1]
    codes = sorted({c["features"] for x in lists.to_pylist() for c in x})
    for accepted in ([], codes[:1], codes[1:], codes):
        for part in (lists, lists.slice(1, 3), lists.slice(2)):
            assert pii.chosen(part, accepted).to_pylist() == [[c for c in x if c["features"] in accepted] for x in part.to_pylist()]


def test_pii_of_nothing(none):
    assert pii.find_spans(none).count() == 0


# ---- 5


def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(fps, radius=3):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= radius:
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(fps))]


def plain_near(rows):
    ids = sorted({r[0] for r in rows})
    text = {r[0]: r[1] for r in rows}
    fps = [plain_fingerprint(text[i]) for i in ids]
    return {i: (f, ids[g]) for i, f, g in zip(ids, fps, plain_groups(fps), strict=True)}


def test_simhash(docs, rows):
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == plain_near(rows)
    assert got[200][1] == 7 and got[100][1] == got[102][1] == 100


def test_vantage_point_trees_lose_no_pair(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base[rng.integers(0, 40, 400)] ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)), rng.integers(0, 2**64, 400, dtype=np.uint64), base]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = simhash.components(simhash.links(df, 3, shard_rows=64, sample_rows=1024))
    got = {r.a: r.b for r in found.collect()}
    signed = fps.view(np.int64).tolist()
    want = plain_groups([int(x) for x in fps])
    groups = collections.defaultdict(list)
    for i, g in enumerate(want):
        groups[g].append(signed[i])
    for members in groups.values():
        if len(members) > 1:
            assert {got.get(m, m) for m in members} == {min(members)}
        else:
            assert members[0] not in got


def test_shards_split_until_they_fit(spark):
    """Tiny shards, a cloud that no vantage point cuts, and far points: no link is lost."""
    rng = np.random.default_rng(4)
    cloud = np.array([int(x) for x in {sum(1 << int(b) for b in rng.choice(24, rng.integers(0, 9), replace=False)) for _ in range(500)}], np.uint64)
    fps = np.unique(np.concatenate([cloud, rng.integers(0, 2**64, 500, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r.a: r.b for r in simhash.components(simhash.links(df, 3, shard_rows=40, sample_rows=256)).collect()}
    signed = fps.view(np.int64)
    label = plain_groups([int(x) for x in fps])
    least = {g: min(int(signed[i]) for i, x in enumerate(label) if x == g) for g in set(label)}
    assert all(got.get(int(v), int(v)) == least[label[i]] for i, v in enumerate(signed))


def test_tree_routes_close_pairs_together():
    rng = np.random.default_rng(6)
    fps = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    near = fps ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64))
    tree = simhash.Tree(3)
    first = tree.grow(-1, *simhash.plant(fps[:500], 3))
    tree.grow(first[2], *simhash.plant(fps[500:900], 2))
    shards = [collections.defaultdict(set), collections.defaultdict(set)]
    for held, x in zip(shards, (fps, near), strict=True):
        for i, n in zip(*tree.route(x), strict=True):
            held[int(i)].add(int(n))
    assert all(shards[0][i] & shards[1][i] for i in range(3000)) and len(set.union(*shards[0].values())) == 8 + 4 - 1


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, j) for j in range(1001, 1100)] + [(5, 5)]
    got = {r.a: r.b for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(i, i) == 0 for i in range(61)) and all(got.get(i, i) == 1000 for i in range(1000, 1100))


def test_keep_first(docs, rows, none, clashing):
    near = plain_near(rows)
    kept = sorted(r.doc_id for r in simhash.keep_first(clashing).collect())
    assert kept == sorted(i for i, (_, c) in near.items() if i == c)
    assert simhash.keep_first(none).count() == 0


# ---- 6


def test_language_model(docs, rows):
    out = pitman_yor.score(docs, crc_mod("doc_id", 10) != 0, chunk_tokens=1500).collect()
    words = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or "")), "\n"]
    c = collections.Counter(w for r in rows if crc(r[0], 10) for w in words(r[1]))
    n, v = sum(c.values()), len(c)
    assert len(out) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in out:
        w = words(text[r.doc_id])
        assert (r.learnt, r.n_tokens, r.n_known, r.train_tokens) == (crc(r.doc_id, 10) != 0, len(w), sum(x in c for x in w), n)
        assert abs(r.base_score - sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) < 1e-6 * len(w) + 1e-9
    held = [r for r in out if not r.learnt]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_hang_on_no_partition(clashing):
    learn = crc_mod("doc_id", 10) != 0
    a = pitman_yor.score(clashing, learn, shards=2).collect()
    b = pitman_yor.score(clashing.repartition(5), learn, shards=37, chunk_tokens=700).collect()
    c = pitman_yor.score(clashing.repartition(3), learn, shards=29, chunk_tokens=500, two_hops=True).collect()
    key = lambda rows: sorted((r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in rows)
    assert np.allclose(np.array(key(a)), np.array(key(b)), atol=1e-9) and np.allclose(np.array(key(a)), np.array(key(c)), atol=1e-9)


def seated(text, contexts, sweeps, model=pitman_yor.MODEL, hyper=False):
    """The distributed sampler's own steps over two shards, without Spark; the last half of the sweeps are samples. Returns shards, samples, hypers."""
    chunk = pitman_yor.Words()
    chunk.add(0, True, text)
    _, asked = pitman_yor._chunk(chunk, 2, contexts)
    shards = [pitman_yor.Shard.of([pitman_yor._unpack(b)], contexts)[0] for _, b in asked]

    def total(d, theta):
        by_part = collections.defaultdict(list)
        for s in shards:
            for part, b in s.sums(contexts, 4):
                by_part[part].append(b)
        return pitman_yor.corpus_totals([pitman_yor._unpack(pitman_yor._added(by_part[i], i == 4)) if i in by_part else None for i in range(5)], contexts, d, theta)

    now, _ = total(model["d"], model["theta"])
    samples, drawn = [], []
    for stream in range(sweeps):
        for s in shards:
            s.sweep(now, stream, model["unknown"], model["reseats"])
        now, sizes = total(now.d, now.theta)
        if stream * 2 >= sweeps:
            samples.append(now)
            for s in shards:
                s.samples += [x.astype(np.uint32) for x in s.tables()]
        if hyper:
            now = pitman_yor.resampled(now, sizes, stream)
            drawn.append((now.d, now.theta))
    return shards, samples, drawn


def plain_sampler(text, contexts, sweeps, model=pitman_yor.MODEL):
    """Hierarchical Pitman-Yor by the book: one customer leaves and is seated again, through all levels, in one process."""
    rng = np.random.default_rng(5)
    words = pitman_yor.tokens(text)
    pairs = [(pitman_yor.context(a, contexts), b) for a, b in zip([b"", *words], words, strict=False)]
    names = sorted(set(words))
    known = (1 - model["unknown"]) / len(names)
    rooms = collections.defaultdict(lambda: collections.defaultdict(list))  # restaurant -> dish -> sizes

    def up(r):
        return ("class", r[1] // (contexts // pitman_yor.CLASSES)) if r[0] == "ctx" else ("root",)

    level = {"ctx": 0, "class": 1, "root": 2}

    def p(r, w):
        i = level[r[0]]
        below = p(up(r), w) if i < 2 else known
        n, t = sum(map(sum, rooms[r].values())), sum(map(len, rooms[r].values()))
        own = rooms[r][w]
        return (sum(own) - model["d"][i] * len(own) + (model["theta"][i] + model["d"][i] * t) * below) / (model["theta"][i] + n)

    def sit(r, w):
        i, own = level[r[0]], rooms[r][w]
        t = sum(map(len, rooms[r].values()))
        odds = [n - model["d"][i] for n in own] + [(model["theta"][i] + model["d"][i] * t) * (p(up(r), w) if i < 2 else known)]
        k = rng.choice(len(odds), p=np.array(odds) / sum(odds))
        if k < len(own):
            own[k] += 1
        else:
            own.append(1)
            if i < 2:
                sit(up(r), w)

    def leave(r, w):
        own = rooms[r][w]
        k = rng.choice(len(own), p=np.array(own) / sum(own))
        own[k] -= 1
        if not own[k]:
            own.pop(k)
            if level[r[0]] < 2:
                leave(up(r), w)

    for u, w in pairs:
        sit(("ctx", u), w)
    total = collections.Counter()
    for n in range(sweeps):
        for u, w in pairs:
            leave(("ctx", u), w)
            sit(("ctx", u), w)
        if n * 2 >= sweeps:
            for u, w in set(pairs):
                total[u, w] += p(("ctx", u), w)
    kept = sweeps - (sweeps + 1) // 2
    return {k: v / kept for k, v in total.items()}, pairs


def test_sampler_agrees_with_the_book():
    """Averaged predictive probabilities against a single-process sampler, discounts and strengths held."""
    rng = np.random.default_rng(7)
    words = "the cat sat on mat and dog ran to park".split()
    text = " ".join(rng.choice(words, 260, p=np.array([9, 5, 4, 4, 3, 3, 2, 2, 1, 1]) / 34))
    contexts = 4096
    want, pairs = plain_sampler(text, contexts, 60)
    shards, samples, _ = seated(text, contexts, 120)
    got = {}
    by_hash = {xxhash.xxh64_intdigest(w): w for _, w in pairs}
    for s in shards:
        logs, _ = s.answers(samples, pitman_yor.MODEL["unknown"])
        got.update({(int(u), by_hash[int(s.names[w])]): 10.0 ** float(x) for u, w, x in zip(s.ctx, s.word, logs, strict=True)})
    assert got.keys() == want.keys()
    a, b = np.array([got[k] for k in want]), np.array([want[k] for k in want])
    assert abs(np.log10(a).sum() - np.log10(b).sum()) / len(a) < 0.02
    assert np.abs(a - b).max() < 0.05 and np.abs(a - b).mean() < 0.01


def test_probabilities_of_a_context_sum_to_one():
    names = np.arange(1, 30, dtype=np.uint64)
    rng = np.random.default_rng(0)
    ctxs = np.array([5, 6, 4000], np.uint32)
    counts = rng.integers(0, 40, (29, 3)).astype(np.uint32)
    counts[-1] = 0  # the one word that isn't known
    counts[3, 1] = 5000
    shard, _ = pitman_yor.Shard.of([[names, np.full(29, 3, np.uint32), np.tile(ctxs, 29), counts.ravel()]], 4096)
    for stream in range(4):
        sums = dict(shard.sums(4096, 4))
        now, sizes = pitman_yor.corpus_totals([pitman_yor._unpack(sums[i]) if i in sums else None for i in range(5)], 4096, *([now.d, now.theta] if stream else [pitman_yor.MODEL["d"], pitman_yor.MODEL["theta"]]))
        if stream:
            shard.samples += [x.astype(np.uint32) for x in shard.tables()]
            logs, _ = shard.answers([now], 0.5)
            shard.samples = []
            assert np.allclose((10.0 ** logs.astype(float)).reshape(29, 3).sum(axis=0), 1, atol=1e-5)
            for seats, people in zip(shard.seats, [shard.c[shard.many], *shard._above(shard.tables()[0])], strict=True):
                assert (seats.customers() == people).all() and (seats.sizes > 0).all()
        now = pitman_yor.resampled(now, sizes, stream)
        assert all(0 < d < 1 for d in now.d) and all(x > 0 for x in now.theta)
        shard.sweep(now, stream, 0.5, 8)


def test_discount_follows_the_text():
    """Many words met once ask for a high discount, a few words met often for a low one."""
    rng = np.random.default_rng(1)
    rare = " ".join(f"w{i}" for i in rng.zipf(1.4, 2500))
    few = " ".join(rng.choice([*"abcdef"], 2500))
    d = [np.mean([x[0][0] for x in seated(t, 4096, 20, hyper=True)[2][10:]]) for t in (rare, few)]
    assert d[0] > d[1] + 0.2


def test_coins_beyond_the_exact_ones():
    rng = np.random.default_rng(0)
    sizes, counts = np.array([5, 900, 5000]), np.array([10, 3, 2])
    a = np.mean([pitman_yor._heads(rng, sizes, counts, lambda j: 0.3 / (j - 0.7)) for _ in range(300)])
    b = np.mean([pitman_yor._heads(rng, sizes, counts, lambda j: 0.3 / (j - 0.7), exact=100) for _ in range(300)])
    assert abs(a - b) < 0.5


def test_language_model_of_nothing(none, docs):
    assert pitman_yor.score(none, F.lit(True)).count() == 0
    out = pitman_yor.score(docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and abs(r.score) < 1e-6 for r in out)


# ---- 7


def test_winnowing_matches_the_definition():
    rng = np.random.default_rng(2)
    mod, base, mix = 1 << 64, 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD
    for _ in range(200):
        t = "".join(rng.choice([*"abé中"], rng.integers(0, 90)))
        k, w = int(rng.integers(1, 9)), int(rng.integers(1, 40))
        kk = min(k, len(t))
        grams = []
        for i in range(len(t) - kk + 1 if t else 0):
            h = 0
            for ch in t[i : i + kk]:
                h = (h * base + (ord(ch) + 1) * mix) % mod
            grams.append(((h ^ h >> 29) * mix % mod) >> 32)
        ww, want = min(w, len(grams)), []
        for s in range(len(grams) - ww + 1 if grams else 0):
            p = max(i for i in range(s, s + ww) if grams[i] == min(grams[s : s + ww]))
            want += [p] if not want or want[-1] != p else []
        hashes, at = winnow.winnow(t, k, w)
        assert at.tolist() == want and hashes.tolist() == [grams[p] for p in want]


def test_shared_passages_share_a_choice():
    shared = "a passage that both of the documents hold in full"
    a, b = winnow.winnow("left side of it " + shared + " and more", 8, 32)[0], winnow.winnow("something else " + shared + "!", 8, 32)[0]
    assert set(a.tolist()) & set(b.tolist())


def test_edits(docs, rows):
    got = sorted((r.doc_id, r.n_chars, r.edited_sha256, r.near_next) for r in winnow.compare_with_edits(docs).collect())
    order = sorted(rows, key=lambda r: (-r[0], r[1] or ""))
    want = []
    for i, r in enumerate(order):
        t, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]
        want.append((r[0], len(t), hashlib.sha256(edited.encode()).hexdigest(), winnow.likeness(winnow.winnow(t)[0], winnow.winnow(nxt)[0])))
    assert got == sorted(want)


def test_positions_are_where_the_choices_stand(docs, rows):
    text = {r[0]: r[1] or "" for r in rows}
    for r in winnow.compare_with_edits(docs).collect():
        hashes, at = winnow.winnow(text[r.doc_id])
        assert r.positions == ",".join(map(str, at)) and r.fingerprint == winnow.shown(hashes) and len(r.edited_positions.split(",")) * 8 == max(8, len(r.edited_fingerprint))


def test_next_across_parts(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(50)] + [(None, "null id")], "doc_id long, text string")
    placed = winnow.with_next(df, rows_each=7)[0].collect()
    assert len({r.part for r in placed}) > 4 and sum(not r.ahead for r in placed) == 51
    out = winnow.compare_with_edits(df).count()
    assert out == 51


def test_fingerprints_of_nothing(none, clashing):
    assert winnow.compare_with_edits(none).count() == 0 and winnow.fingerprints(none).count() == 0
    assert winnow.fingerprints(clashing).where("doc_id = 100").first().hashes == []


# ---- 8


def test_token_counts(docs, rows):
    path = P.path("byte_bpe_50k.json")
    assert ranks_agree(path)
    got = sorted(tuple(r) for r in token_counts.count_tokens(docs, path).collect())
    assert got == sorted((r[0], len((r[1] or "").encode()), len(library(path).encode(r[1] or "", add_special_tokens=False))) for r in rows)


def test_piece_lengths_are_the_librarys():
    path = P.path("byte_bpe_50k.json")
    rng = np.random.default_rng(3)
    marks = ["\0", "a", "the", "The", ".", ",", "'s", " ", "  ", "\n", "\n\n", "\t", "é", "ß", "1", "23", "<|endoftext|>", "%%", "\x1c", "\xa0", "́", "²", "中", "\r\n", "\x85", "Σ", "　"]
    texts = ["".join(rng.choice(marks, rng.integers(0, 30))) for _ in range(4000)]
    lengths = token_counts.PieceLengths(path, True, most=300)
    assert lengths.count(texts) == lengths.encode(texts)
    slow = token_counts.PieceLengths(path, False)
    assert slow.count(texts[:500]) == slow.encode(texts[:500])


def test_long_runs_are_split_safely():
    path = P.path("byte_bpe_50k.json")
    rng = np.random.default_rng(12)
    base64 = "".join(rng.choice([*"ABCdefXYZ0123456789+/="], 60_000))
    texts = [base64, "中文，文字。" * 9000, "it's1a" * 9000, "<|endoftext|>" * 3000, "word " + base64 + " end", "é1" * 20_000, "日本語です。next、" * 5000, "a b" * 20_000, "x" * 40_000, "1'll" * 9000]
    lengths = token_counts.PieceLengths(path, True)
    assert lengths.count(texts) == [len(library(path).encode(t, add_special_tokens=False)) for t in texts]


def test_workers_keep_their_collector():
    import gc

    from chronosift.llm.common import collector_off

    with collector_off():
        assert not gc.isenabled()
    assert gc.isenabled()


def test_token_counts_of_nothing(none):
    assert token_counts.count_tokens(none, P.path("byte_bpe_50k.json")).count() == 0


# ---- 9


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vecs = rng.normal(0, 0.3, (300, 12)).astype(np.float32)
    vecs[50:90] = vecs[50]  # ties
    data = [(i, [float(x) for x in v], "x") for i, v in enumerate(vecs)]
    data += [(400, None, "x"), (420, [1.0, None] + [0.0] * 10, "x"), (440, [float("nan")] * 12, "x"), (460, [float("inf")] * 12, "x"), (480, [], "x"), (None, [0.5] * 12, "x"), (500, [1e30] * 12, "x"), (520, [0.5] * 3, "x")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, score string")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=20, cand_rows=64, query_rows=5).collect())
    usable = {i: [math.floor(64 * float(np.float32(x))) for x in v] for i, v, _ in data if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    usable = {i: v + [0] * (12 - len(v)) for i, v in usable.items()}
    want = []
    for q in [i for i in usable if i % 20 == 0]:
        scores = [(max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(usable[q], v, strict=True)))), i) for i, v in usable.items() if i != q]
        want += [(q, n + 1, i, s) for n, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:20])]
    assert got == sorted(want)


def test_top_k_over_many_partitions(spark):
    """Candidates in many tasks and blocks, queries in many groups."""
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 0.2, (400, 6)))], "vec_id long, embedding array<double>")
    key = lambda out: sorted(tuple(r) for r in out.collect())
    one = topk.top_k(df.coalesce(1), F.col("vec_id") % 20 == 0, k=5)
    out = topk.top_k(df.repartition(13), F.col("vec_id") % 20 == 0, k=5, cand_rows=7, query_rows=6)
    assert key(out) == key(one) and one.count() == 100
    assert {c: t for c, t in out.dtypes} == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}


def test_first_candidates_are_resolved_exactly():
    rng = np.random.default_rng(13)
    vecs = np.floor(rng.normal(0, 9, (300, 7)))
    vecs[40:60] = vecs[40]
    ids = rng.permutation(300)
    got = topk.resolved(ids, vecs, ids[::20], vecs[::20], 12)
    for at, own in zip(range(0, 300, 20), got, strict=True):
        scores = vecs @ vecs[at]
        assert own == sorted((-int(scores[j]), int(ids[j])) for j in range(300) if j != at)[:12]


def searched(vecs, k, blocks=1):
    """Entries read and products computed of no-random-access searches, as shares of brute force; results are checked."""
    vecs = np.floor(vecs)
    parts = [topk.Block(np.arange(len(vecs))[i::blocks], vecs[i::blocks]) for i in range(blocks)]
    queries = range(0, len(vecs), 20)
    for q in queries:
        best, depth = [], topk.FIRST
        for part in parts:
            best, depth = part.search(q, vecs[q], k, best, depth)
        scores = vecs @ vecs[q]
        assert best == sorted((-int(scores[i]), i) for i in range(len(vecs)) if i != q)[:k]
    brute = len(queries) * vecs.size
    return sum(p.read for p in parts) / brute, sum(p.resolved for p in parts) / brute


def test_reading_stops_early_where_few_components_decide():
    rng = np.random.default_rng(10)
    skewed = rng.normal(0, 30, (2000, 32)) * (0.5 ** np.arange(32)) * rng.pareto(2, (2000, 1))
    read, resolved = searched(skewed, 10)
    assert read + resolved < 0.6
    even, all_resolved = searched(rng.normal(0, 8, (2000, 32)), 10)
    assert read < even <= 1 and all_resolved < 1
    assert sum(searched(skewed, 10, blocks=4)) < 0.9


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, F.col("vec_id") % 20 == 0).count() == 0


# ---- 10


def check_packing(pieces, ids, window=4096):
    """Every id of every document in one piece, sequences gapless and not too long; the share of padding."""
    by_doc = collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for i, own in ids.items():
        raw = np.array([*own, 2], "<u4")
        whole = by_doc[i]
        copies = len(whole) // len({(p.start) for p in whole})
        for start, at in collections.Counter(p.start for p in whole).items():
            assert at == copies and start is not None
        for p in whole:
            assert p.doc_tokens == len(raw) and p.ids_crc32 == zlib.crc32(raw[p.start : p.start + p.length].tobytes())
        assert sum(p.length for p in whole) == copies * len(raw)
    fill = collections.defaultdict(list)
    for p in pieces:
        fill[p.sequence_id].append((p.offset, p.length))
    padded = 0
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    return padded / sum(p.length for p in pieces)


def test_packing(docs, rows):
    path = P.path("word_bpe_49k.json")
    ids = {r[0]: library(path).encode(r[1] or "", add_special_tokens=False).ids for r in rows}
    check_packing(packing.pack(docs, path).collect(), ids)


def test_word_ids_are_the_librarys():
    path = P.path("word_bpe_49k.json")
    assert ranks_agree(path)
    rng = np.random.default_rng(5)
    marks = ["\0", "a", "The", "Le", "É", "é", "Àü", ".", ",", "'s", "'T", " ", "  ", "\n", "\t", "ß", "1", "<|endoftext|>", "<|STARTOFTEXT|>", "\x1c", "\xa0", "́", "²", "中", "\r\n", "|", "Σ", "İ", "ǅ", "÷"]
    texts = ["".join(rng.choice(marks, rng.integers(0, 30))) for _ in range(4000)]
    words = packing.WordIds(path, True, most=300)
    assert words.ids(texts) == words.encode(texts)


def test_plan_fills_windows():
    rng = np.random.default_rng(6)
    counts = np.bincount(np.minimum(4096, (rng.lognormal(6.3, 1.0, 40_000)).astype(int) + 1), minlength=4097)
    counts[700] += 15_000  # one length holds a third
    plan, n = packing.plan_windows(counts, 4096)
    total = int((counts * np.arange(4097)).sum())
    assert total / (n * 4096) > 0.995
    assert len(plan) < 40_000
    # ranks of each length are covered once
    ends = collections.Counter()
    for length, first, _, _ in plan.tolist():
        assert first == 0 or ends[length] <= first
        ends[length] = first


def test_packing_of_nothing(none, clashing):
    path = P.path("word_bpe_49k.json")
    assert packing.pack(none, path).count() == 0
    assert packing.pack(clashing, path).where("doc_id = 101").select("length", "doc_tokens").first()[:] == (1, 1)


# ---- all


def test_queries_on_odd_and_empty_tables(spark, rows, tmp_path):
    """Every query over documents, with null ids and columns, repeated rows and copies, and over an empty table: the contract's columns, a row for each."""
    from chronosift.llm import registry

    more = [(None, "no id at all", "en", "src0", 9), (None, None, None, None, None), (-7, "negative id", "en", "src1", 3)]
    for name, data in (("odd", [*rows, *more]), ("none", [])):
        spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/{name}/documents.parquet")
    want = {
        1: "doc_id held_out lang_pred score", 2: "doc_id prob sampled", 3: "doc_id n_lines n_dropped kept_sha256", 4: "doc_id n_email n_ip n_card n_phone base_sha256 spans", 5: "doc_id fingerprint component_id",
        6: "doc_id held_out n_tokens n_known train_tokens base_score score", 7: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next", 8: "doc_id n_bytes n_tokens over_limit",
        10: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    }
    for query, fn in registry.QUERIES.items():
        n = int(query[2:].split("_")[0]) if query.startswith("op") else 0
        if n not in want:
            continue
        out = fn(spark, f"{tmp_path}/odd")
        assert set(want[n].split()) <= set(out.columns), query
        got = out.collect()
        assert (sum(r.start == 0 for r in got) if n == 10 else len(got)) == len(rows) + 3, query
        if "held_out" in out.columns:
            mod = 4 if n == 1 else 10
            assert all(r.held_out == (r.doc_id is not None and crc(r.doc_id, mod) == (2 if n == 1 else 0)) for r in got), query
        assert fn(spark, f"{tmp_path}/none").count() == 0, query


def test_clashing_columns(clashing, docs):
    """Columns of names that operators use inside change nothing."""
    key = lambda df: sorted(map(str, df.collect()))
    for run in (pii.find_spans, simhash.near_duplicates, lambda d: token_counts.count_tokens(d, P.path("byte_bpe_50k.json")), winnow.compare_with_edits, lambda d: langid.predict(d, langid.train(docs, F.lit(True)))):
        assert key(run(clashing)) == key(run(docs))


def test_top_k_with_clashing_columns(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "vec_id long, embedding array<double>")
    more = df.select("*", *[F.lit("x").alias(c) for c in ("id", "q", "v", "rank", "score", "query_id")])
    run = lambda d: sorted(map(tuple, topk.top_k(d, F.col("vec_id") % 20 == 0, k=3).collect()))
    assert run(df) == run(more)
