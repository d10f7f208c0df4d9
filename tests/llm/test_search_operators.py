"""Language identification, periodic runs and vector codes against plain versions."""

import hashlib
import math
import random
import time
import unicodedata
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from check_oracle import TABLES, compare
from clickroll.llm import html_extract, language_id, periodic_runs, vector_codes

from .brute import WORD, sha

SF = "/root/testdata/sf0.01"


# ---- periodic runs

def smallest_period(words):
    fail = [0] * len(words)
    for i in range(1, len(words)):
        k = fail[i - 1]
        while k and words[i] != words[k]:
            k = fail[k - 1]
        fail[i] = k + (words[i] == words[k])
    return len(words) - fail[-1]


def plain_runs(words):
    """Every lag in turn, every stretch of equal pairs."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(24, 3 * q) and smallest_period(words[i:i + size]) == q:
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    return [w for i, w in enumerate(words) if not any(a + p <= i < a + n for a, n, p in runs)]


def repetitive(rnd):
    n, letters, kind = rnd.randint(0, 160), rnd.choice([1, 2, 2, 3, 30]), rnd.randint(0, 4)
    if kind == 0:
        return [rnd.randrange(letters) for _ in range(n)]
    words = []
    while len(words) < n:
        block = [rnd.randrange(letters) for _ in range(rnd.randint(1, 40))]
        if kind >= 2 and rnd.random() < .5:
            block = block * rnd.randint(1, 4) + [rnd.randrange(letters)]
        if kind == 4:  # every 16-gram of the period occurs twice in it
            x = [0] * 15
            block = [1, *x, 1, *x, 2, *x, 2, *x]
        words += (block * rnd.randint(1, 6))[:rnd.randint(1, len(block) * 6)]
    return words[:n * 3]


def test_runs_equal_a_plain_search():
    rnd, total = random.Random(5), 0
    for _ in range(400):
        docs = [[str(w) for w in repetitive(rnd)] for _ in range(rnd.randint(1, 4))]
        for words, got in zip(docs, periodic_runs.runs_of(*periodic_runs.numbered(docs)), strict=True):
            want = plain_runs(words)
            total += len(want)
            assert got == want
            assert periodic_runs.kept(words, got) == plain_collapse(words, got)
    assert total > 300


def test_runs_survive_equal_hashes(monkeypatch):
    """A false k-gram match is noticed, and the search repeated under other hashes."""
    mixed = periodic_runs._mix
    rnd = random.Random(6)
    docs = [[str(rnd.randrange(3)) for _ in range(60)] + ["a", "b"] * 20 for _ in range(20)]
    want = [plain_runs(d) for d in docs]
    calls = []
    start = periodic_runs._Grams.__init__

    def weak_first(self, words, begins, seed):
        calls.append(seed)
        monkeypatch.setattr(periodic_runs, "_mix", mixed if seed else (lambda x: mixed(x) % np.uint64(5)))
        start(self, words, begins, seed)
    monkeypatch.setattr(periodic_runs._Grams, "__init__", weak_first)
    assert periodic_runs.runs_of(*periodic_runs.numbered(docs)) == want
    assert calls == [0, 1]


@pytest.mark.parametrize("words", [["a"] * 400_000, ["a", "a", "b"] * 130_000, [str(i % 3001) for i in range(400_000)]])
def test_runs_of_long_repeats_take_linear_time(words):
    def seconds(n):
        began = time.process_time()
        assert len(periodic_runs.runs_of(*periodic_runs.numbered([words[:n]]))[0]) == 1
        return time.process_time() - began
    seconds(20_000)
    assert seconds(len(words)) < 3 * seconds(len(words) // 2) + 0.5


def test_summary_takes_the_greatest_exact_exponent():
    runs = [(0, 30, 10), (5, 60, 20), (70, 91, 30), (70, 24, 8)]
    s = periodic_runs.summary(["w"] * 200, sorted(runs, key=lambda r: (r[0], r[2])))
    assert s.best == (70, 91, 30)
    s = periodic_runs.summary(["w"] * 200, [(0, 30, 10), (5, 60, 20)])
    assert s.best == (0, 30, 10)  # a tie: the smaller start
    assert s.runs_sha256 == sha("0,30,10\n5,60,20\n")


def test_runs_query_edge_cases(spark, edge, empty):
    got = periodic_runs.digests(edge, plant=True).collect()
    assert len(got) == edge.count()
    by = Counter(r.doc_id for r in got)
    assert by[3] == 2 and by[None] == 2
    first = {r.doc_id: r for r in got}
    assert (first[1].n_runs, first[1].start, first[1].runs_sha256, first[1].collapsed_sha256) == (0, None, sha(""), sha(""))
    assert (first[3].n_runs, first[3].period, first[3].length, first[3].exponent_milli) == (1, 1, 30_000, 30_000_000)
    assert first[3].collapsed_sha256 == sha("word")
    assert periodic_runs.digests(empty).count() == 0
    full = {r.doc_id: r for r in periodic_runs.find(edge).collect()}
    assert [tuple(x) for x in full[3].runs] == [(0, 30_000, 1)] and full[3].collapsed == "word"


def test_runs_query_plants_as_agreed(spark):
    rnd = random.Random(7)
    docs = [(i, " ".join(str(w) for w in repetitive(rnd))) for i in range(300)]
    got = {r.doc_id: r for r in periodic_runs.digests(spark.createDataFrame(docs, "doc_id long, text string"), plant=True).collect()}
    import zlib
    for i, text in docs:
        words = WORD.findall(text)
        h, n = zlib.crc32(str(i).encode()), len(WORD.findall(text))
        if h % 10 == 0 and n:
            a, g = h // 10 % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        runs = plain_runs(words)
        assert got[i].n_runs == len(runs)
        assert got[i].runs_sha256 == sha("".join(f"{a},{n},{p}\n" for a, n, p in runs))
        assert got[i].collapsed_sha256 == sha(" ".join(plain_collapse(words, runs)))


# ---- vector codes

def plain_codes(rows, rounds=6, entries=16):
    """(vec_id, label, vector) rows to (vec_id, code, error, label_error, digest), in Python integers."""
    kept = [(i, lab, [math.floor(4096 * x) for x in v]) for i, lab, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    size = max(1, -(-max(len(v) for _, _, v in kept) // 8))
    kept = [(i, lab, [(v + [0] * (8 * size))[p * size:(p + 1) * size] for p in range(8)]) for i, lab, v in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[r[2][p] for r in first] for p in range(8)]

    def nearest(part, book):
        away = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in book]
        return away.index(min(away)), min(away)
    for _ in range(rounds):
        for p in range(8):
            got = [nearest(r[2][p], books[p])[0] for r in kept]
            for k in range(len(books[p])):
                mine = [r[2][p] for r, g in zip(kept, got, strict=True) if g == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = [(i, lab, [nearest(v[p], books[p]) for p in range(8)]) for i, lab, v in kept]
    total = Counter()
    for _, lab, got in out:
        total[lab] += sum(d for _, d in got)
    digest = sha(",".join(str(c) for book in books for e in book for c in e))
    return [(i, "".join(f"{k:02x}" for k, _ in got), sum(d for _, d in got), total[lab], digest) for i, lab, got in out]


VECTORS = "vec_id long, embedding array<float>, label int"


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r))


@pytest.mark.parametrize("seed", range(3))
def test_codes_equal_plain_lloyd(spark, seed):
    rng = np.random.default_rng(seed)
    n, dim = [(300, 16), (90, 24), (9, 8)][seed]
    centres = rng.normal(0, 1, (6, dim))
    rows = [(int(i), [float(np.float32(x)) for x in centres[rng.integers(6)] + rng.normal(0, .05 * (i % 3), dim)],
             None if i % 7 == 0 else int(i % 4)) for i in rng.permutation(n)]
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = [tuple(r) for r in vector_codes.report(frame).collect()]
    assert order(got) == order(plain_codes([(i, lab, v) for i, v, lab in rows]))


def test_tree_assignment_equals_brute_force():
    rng = np.random.default_rng(1)
    for trial in range(60):
        n, length, span, k = int(rng.integers(0, 400)), int(rng.integers(1, 9)), int(rng.choice([1, 3, 50, 4000])), int(rng.integers(1, 17))
        points = rng.integers(-span, span + 1, (n, 8, length))
        if trial % 3 == 0 and n:
            points[rng.integers(0, n, n)] = points[0]
        if trial % 4 == 0 and n:
            points = points + (rng.integers(-span, span + 1, (5, 8, length)) * 50)[rng.integers(0, 5, n)]
        books = points[rng.integers(0, n, k)] if n else rng.integers(0, 3, (k, 8, length))
        books = np.ascontiguousarray(books.transpose(1, 0, 2))
        codes, counts, sums = vector_codes.assign(points, vector_codes.grow(points, vector_codes.LEAF), books)
        want = ((points[:, :, None, :] - books[None]) ** 2).sum(3).argmin(2)
        assert (codes == want).all()
        for p in range(8):
            for e in range(k):
                assert counts[p, e] == (want[:, p] == e).sum()
                assert (sums[p, e] == points[want[:, p] == e, p].sum(0)).all()


def test_whole_nodes_are_assigned_by_their_sums(monkeypatch):
    """On clustered points few leaves compare integers."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-4000, 4000, (16, 8, 8))
    points = centres[rng.integers(0, 16, 4000)] + rng.integers(-20, 21, (4000, 8, 8))
    met = []
    monkeypatch.setattr(np, "argmin", lambda x, *a, f=np.argmin, **k: (met.append(len(x)), f(x, *a, **k))[1])
    vector_codes.assign(points, vector_codes.grow(points, vector_codes.LEAF), np.ascontiguousarray(centres.transpose(1, 0, 2)))
    assert sum(met) < 0.1 * points.shape[0] * 8


def test_codes_edge_cases(spark):
    huge = 3.0e38
    rows = [(None, [1.0] * 8, 1), (5, None, 1), (6, [1.0, None] * 4, 1), (7, [float("nan")] * 8, 1), (8, [float("inf")] * 8, 2),
            (9, [], None), (9, [], None), (10, [0.5] * 3, None), (11, [-0.0001] * 11, 2), (3, [0.25] * 8, 2), (3, [0.25] * 8, 2)]
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS code", "2 AS error", "3 AS v", "4 AS slot", "5 AS _key")
    got = [tuple(r) for r in vector_codes.report(frame).collect()]
    assert order(got) == order(plain_codes([(i, lab, v) for i, v, lab in rows]))
    assert vector_codes.report(spark.createDataFrame([], VECTORS)).count() == 0
    assert vector_codes.report(spark.createDataFrame([(1, None, 1)], VECTORS)).count() == 0
    big = vector_codes.report(spark.createDataFrame([(i, [huge * (-1) ** i] * 8, 1) for i in range(20)], VECTORS)).collect()
    assert len(big) == 20 and all(r.error >= 0 for r in big)


# ---- language

def test_counts_equal_plain_grams():
    """As many n-grams as the folded text has, equal for texts that fold alike."""
    for text in ("Abc, déf!  42 x", "É", "  a1b  ", "ß" * 50, "日本 語"):
        folded = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
        x = f" {folded} "
        want = Counter(x[i:i + n] for n in range(1, 5) for i in range(len(x) - n + 1))
        want[" "] -= 1
        got = language_id.counts(text, 20)
        assert got.sum() == sum(want.values())
        assert sorted(got[got > 0].tolist()) == sorted(n for n in want.values() if n)
        assert (got == language_id.counts(f"..{folded.upper() if 'ß' not in text else folded}!", 20)).all()
    assert language_id.counts("12 !? _ ½") is None and language_id.counts(None) is None


def test_nearest_equals_plain_cosines():
    rng = np.random.default_rng(3)
    size = 1 << language_id.BITS
    idf = rng.random(size).astype(np.float32) + 1
    centroids = rng.random((5, size)).astype(np.float32)
    centroids /= np.linalg.norm(centroids, axis=1, keepdims=True)
    model = language_id.Model(idf, ["a", "a", "b", "c", "c"], centroids, np.full(5, 0.9))
    texts = [None, "", "42", "one two three", "drei vier", "x"] * 30
    for text, (lang, score, rejected) in zip(texts, language_id.nearest(texts, model), strict=True):
        found = language_id.counts(text)
        if found is None:
            assert (lang, score, rejected) == ("und", 0.0, True)
            continue
        v = {i: (1 + math.log(n)) * float(idf[i]) for i, n in enumerate(found) if n}
        norm = math.sqrt(sum(x * x for x in v.values()))
        cosines = [sum(x * float(c[i]) for i, x in v.items()) / norm for c in centroids]
        best = cosines.index(max(cosines))
        assert lang == model.languages[best] and abs(score - cosines[best]) < 1e-5
        assert rejected == (1 - cosines[best] > 0.9)


def test_clusters_are_spherical_means():
    rng = np.random.default_rng(4)
    base = np.eye(6, dtype=np.float32)[[0, 2, 4]]
    v = np.concatenate([base[i] + rng.normal(0, .02, (40, 6)) for i in range(3)]).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    centroids, reach = language_id.cluster(v)
    owner = np.argmax(v @ centroids.T, axis=1)
    for c in range(3):
        mean = v[owner == c].sum(0)
        assert np.allclose(centroids[c], mean / np.linalg.norm(mean), atol=1e-5)
    assert len(set(owner[:40])) == 1 and len(set(owner.tolist())) == 3 and (reach < 0.1).all()
    same, reach = language_id.cluster(np.tile(base[:1], (5, 1)))
    assert len(same) == 1 and reach[0] == 0


def test_held_out_languages_are_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang", F.length("text").alias("n")), "doc_id").where("held_out").collect()
    assert len(got) > 200
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_foreign_texts_are_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.length("text") > 300)
    model = language_id.fit(docs.select("doc_id", "lang", "text"))
    own = language_id.nearest([r.text for r in docs.select("text").collect()], model)
    alien = ["".join(unicodedata.lookup("CYRILLIC SMALL LETTER " + x) for x in ("A", "BE", "VE", "GHE")) + " " for _ in range(5)]
    assert sum(r for _, _, r in own) < 0.05 * len(own)
    assert all(r and lang in {"en", "fr", "de", "es"} for lang, _, r in language_id.nearest([a * 30 for a in alien], model))


def test_prediction_reads_only_the_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs.select("doc_id", "lang", "text"))
    a = {r.doc_id: tuple(r) for r in language_id.predict(docs.limit(50), model).collect()}
    b = {r.doc_id: tuple(r) for r in language_id.predict(docs.limit(50).withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), model).collect()}
    assert a == b
    # labels of held-out rows make no difference
    wrong = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    one, two = language_id.identify(docs).collect(), language_id.identify(wrong).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_language_edge_cases(spark, edge, empty):
    got = language_id.identify(edge).collect()
    assert len(got) == edge.count()
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 4, 7) or (r.doc_id is None and r.score == 0.0))
    assert language_id.identify(empty).count() == 0
    none = language_id.identify(edge.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    many = spark.range(language_id.MAX_LANGUAGES + 5).selectExpr("id AS doc_id", "concat('l', id) AS lang", "'abc' AS text")
    with pytest.raises(ValueError, match="languages"):
        language_id.fit(many)


@pytest.mark.parametrize("name", ["op12_periodic_runs", "op13_vector_codes"])
def test_queries_match_sql_on_the_larger_table(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rec = compare(spark, con, name, SF)
    assert rec["cols_match"] and rec["hash_match"], rec


def test_digest_of_entries(spark):
    frame = spark.createDataFrame([(i, [float(i)] * 8, 0) for i in range(3)], VECTORS)
    got = vector_codes.report(frame).first()
    assert got.codebooks_sha256 == hashlib.sha256(",".join(str(4096 * i) for _ in range(8) for i in range(3)).encode()).hexdigest()


# ---- pages without an article element

LONG_P = "<p>" + "A paragraph of the story, long enough to score, with commas, and more of them. " * 4 + "</p>"
LONG_T = ("A paragraph of the story, long enough to score, with commas, and more of them. " * 4).strip()


@pytest.mark.parametrize("page, want", [
    # the body itself: heading, lead, quote, list and closing line stay
    (f"<body><nav><a href=x>Home</a></nav><h1>Title</h1><p>Lead.</p>{LONG_P}{LONG_P}<blockquote>Said so, twice, and again.</blockquote>"
     "<ul><li>one</li><li>two</li></ul>Bye.<footer>c</footer></body>",
     ["Title", "Lead.", LONG_T, LONG_T, "Said so, twice, and again.", "one", "two", "Bye."]),
    # two divs beside each other, each with a heading
    (f"<body><h1>Title</h1><p>Lead.</p><div><h2>One</h2>{LONG_P}{LONG_P}</div><div><h2>Two</h2>{LONG_P}<p>Short.</p></div><p>End.</p></body>",
     ["Title", "Lead.", "One", LONG_T, LONG_T, "Two", LONG_T, "Short.", "End."]),
    # an unmarked list of links beside the text goes, a link in a sentence stays
    (f"<body><div><div>{LONG_P}{LONG_P}</div><ul><li><a href=1>first link</a></li><li><a href=2>second link</a></li></ul></div>"
     "<p>More at <a href=3>this place</a>, they say, and elsewhere.</p></body>",
     [LONG_T, LONG_T, "More at this place, they say, and elsewhere."]),
    # nothing outside the main element
    (f"<body><div>Outside the main part.</div><main><h1>T</h1><section>{LONG_P}</section><p>Last.</p></main><div>After.</div></body>",
     ["T", LONG_T, "Last."])])
def test_pages_without_an_article(page, want):
    assert html_extract.main_text(page) == "\n".join(want)


@pytest.mark.parametrize("page", [
    lambda n: "<i>x" * n + "</b>" * n, lambda n: "<i>x" * n + "<hr>" * n, lambda n: "<div>" * n + "<header>y</header>" * n,
    lambda n: "<b><div>" + "<i>" * n + "</b>" * n, lambda n: "<i>" * n + "<li>z" * n, lambda n: "<span>" * n + "t<p>u" * n])
def test_extraction_time_is_linear(page):
    def seconds(n):
        began = time.process_time()
        html_extract.main_text(page(n))
        return time.process_time() - began
    seconds(500)
    assert seconds(40_000) < 3 * seconds(20_000) + 0.3
