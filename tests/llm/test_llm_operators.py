"""Operators of ``llm`` against brute force, and their edge cases."""

import gzip
import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reglink.llm import decontaminate, frames, language, licenses, lines, minhash, packing, quality, queries, secrets, substrings, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, class int, n int, `h1` string, removed int"
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return (text or "").encode().lower().decode()


def odd_texts():
    """Nulls, empty and white-space texts, one long text, copies, repeated
    rows and null ids."""
    rng = random.Random(3)
    words = [rng.choice("abcdeé") * rng.randint(1, 4) + str(rng.randint(0, 40)) for _ in range(400)]
    base = " ".join(words[:120])
    near = " ".join([*words[:60], "other", *words[61:120]])
    long = " ".join(rng.choice(words) for _ in range(60_000))
    lines_ = "one line here\nsecond line here\nthird line here\nfourth line\nfifth line\nsixth line"
    texts = [None, "", " \t\n", "one", "One two", base, base, near, long, "a " * 200, lines_, "top\n" + lines_, "x" * 5000, "!!! ???", "Ünïcödé wörds\x0bapart", base.upper()]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, (None, base), (None, None), (5, base), (5, base)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 1, 2, "h", 3) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, odd_texts())


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def table(spark, name):
    return frames.read(spark, SF, name)


def got(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# --- packing ---------------------------------------------------------------


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(30):
        histogram = {x: rng.randint(1, 9) for x in rng.sample(range(1, 30), rng.randint(1, 8))}
        k = rng.randint(1, 4)
        cost = lambda ends: sum(n * (min(e for e in ends if e >= x) - x) for x, n in histogram.items())  # noqa: B023, E731
        top = max(histogram)
        best = min(cost((*c, top)) for r in range(k) for c in itertools.combinations([x for x in histogram if x != top], r))
        ends = packing.boundaries(histogram, k)
        assert len(ends) <= k and cost(ends) == best


def test_packing_odd(spark, odd, empty):
    out = got(packing.pack(packing.lengths(odd), max_length=64, budget=256, buckets=3))
    n = Counter()
    for r in out:
        n[r["key"]] += r["length"]
    for i, t in odd_texts():
        assert n[i] == sum(len(PLAIN.findall(x or "")) for j, x in odd_texts() if i == j)
    batches = defaultdict(list)
    for r in out:
        if r["length"]:
            assert r["length"] <= r["bucket"]
            batches[r["bucket"], r["batch"]].append(r["slot"])
        else:
            assert r["bucket"] is None and r["batch"] is None
    for (bucket, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) * bucket <= 256
    for bucket in {b for b, _ in batches}:
        sizes = [len(s) for (b, _), s in sorted(batches.items()) if b == bucket]
        assert all(x == 256 // bucket for x in sizes[:-1])
    assert packing.pack(packing.lengths(empty)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(packing.lengths(empty), max_length=10, budget=5)


def test_packing_with_a_tokenizer(spark, odd):
    P = pytest.importorskip("public_tokenizers")
    path = P.path("byte_bpe_50k.json")
    small = odd.where("length(text) < 2000")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    found = Counter((r["key"], r["n_tokens"]) for r in got(packing.lengths(small, tokenizer=path)))
    want = Counter((r.doc_id, len(t.encode(r.text, add_special_tokens=False).ids)) for r in small.select("doc_id", "text").collect())
    assert found == want


# --- near duplicates -------------------------------------------------------


def components(texts, size, per, of):
    sets = []
    for t in texts:
        w = PLAIN.findall(fold(t))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and of * common >= per * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    return sets, [find(i) for i in range(len(texts))]


def check_near(rows, out, size, per, of):
    sets, root = components([t for _, t in rows], size, per, of)
    ids = defaultdict(list)
    for (i, _), r in zip(rows, root, strict=True):
        ids[r].append(i)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    want = Counter((i, len(s), least[r], i == least[r]) for (i, _), s, r in zip(rows, sets, root, strict=True))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out) == want


def test_near_duplicates_odd(spark, odd, empty):
    rows = odd_texts()
    check_near(rows, got(minhash.near_duplicates(odd)), 3, 85, 100)
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.keep_one(odd)
    assert kept.columns == odd.columns
    _, root = components([t for _, t in rows], 5, 80, 100)
    groups = Counter()
    for r in kept.collect():
        groups[root[rows.index((r.doc_id, r.text))]] += 1
    assert set(groups) == set(root) and set(groups.values()) == {1}


def test_near_duplicates_of_a_long_list(spark, monkeypatch):
    """More members than SMALL: leaders, pivots and later rounds, with texts
    around the threshold and chains of links."""
    monkeypatch.setattr(minhash, "SMALL", 3)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        w = list(base)
        for p in rng.sample(range(150), rng.randint(0, 9)):
            w[p] = f"x{rng.randint(0, 30)}"
        rows.append((i, " ".join(w)))
    check_near(rows, got(minhash.near_duplicates(frame(spark, rows))), 3, 85, 100)


def test_near_duplicates_just_below_the_threshold(spark, monkeypatch):
    """Every text is its own edit of one base, about 0.84 alike any other:
    the pairs compared grow with the texts, not with their square. Some have
    a linked partner, among them texts of other sizes."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(142)]
    rows = []
    for i in range(300):
        w = list(base)
        for j, p in enumerate(range(rng.randint(2, 30), 138, 32)):
            w[p] = f"x{i}_{j}"
        rows.append((len(rows), " ".join(w)))
        if i % 10 == 0:
            rows.append((len(rows), " ".join([*w, *[f"y{i}_{j}" for j in range(i % 30)]])))
    pairs, confirm = [], minhash.confirm
    monkeypatch.setattr(minhash, "confirm", lambda near, *a: (pairs.append(near.count()), confirm(near, *a))[1])
    check_near(rows, got(minhash.near_duplicates(frame(spark, rows))), 3, 85, 100)
    assert sum(pairs) < 20 * len(rows)


def test_texts_of_compared_classes_only_are_stored(spark, monkeypatch):
    """Texts share one or two of their three passages, so they stand in lists
    together, but only one pair is alike enough to be compared."""
    passage = [" ".join(f"p{i}_{k}" for k in range(30)) for i in range(6)]
    rows = [(i, " ".join(passage[j] for j in three)) for i, three in enumerate(itertools.combinations(range(6), 3))]
    rows.append((len(rows), rows[3][1] + " end"))
    stored, keep = [], frames.keep
    monkeypatch.setattr(frames, "keep", lambda df: (out := keep(df), stored.append(out.count()) if df.columns == ["class", "body"] else None)[0])
    check_near(rows, got(minhash.near_duplicates(frame(spark, rows))), 3, 85, 100)
    assert stored[0] == 2


def test_least_matches_and_contract(spark):
    m = minhash.least_matches(0.85)
    tail = lambda m: sum(math.comb(128, k) * 0.85**k * 0.15 ** (128 - k) for k in range(m))
    assert tail(m) <= minhash.MISS < tail(m + 1)
    edges = [(f"n{i:03}", f"n{i + 1:03}") for i in range(60) if i % 20] + [("z1", "z2")]
    out = {r.node: r.root for r in minhash.contract(spark.createDataFrame(edges, "a string, b string")).collect()}
    groups = defaultdict(set)
    for k, v in out.items():
        groups[v].add(k)
    assert sorted(len(g) for g in groups.values()) == [2, 20, 20, 20]


# --- secrets ---------------------------------------------------------------


def brute_spans(text):
    found = []
    for order, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), order, rule.kind, m.end()))
    return sorted(found)


SECRETS = [
    'é token = "abcdef1234"', "Password: short", "PASSWD:longenough", "api_key='0123456789abcdef01234567'", "AKIA" + "A" * 15, "AKIA" + "B" * 16,
    "a" * 23, "f" * 24 + "g" + "0" * 30, "ſecret = abcdefgh", "toKen = abcdefgh", "secret = abc secret = abcdef", "-----BEGIN RSA PRIVATE KEY-----",
    "ghp_" + "a1" * 18, "https://user:pass@host/x", "", None, "secret=abcdef" * 3,
]


def test_secret_scan(spark, empty):
    rows = [(i, t) for i, t in enumerate(SECRETS)] + [(100, SECRETS[0]), (None, SECRETS[0]), (0, SECRETS[0])]
    docs = frame(spark, rows)
    out = got(secrets.report(docs, frames.keep(secrets.scan(docs))))
    assert len(out) == len(rows)
    text = {i: t for i, t in rows if i is not None} | {None: SECRETS[0]}
    for r in out:
        spans = brute_spans(text[r["doc_id"]])
        said = [f"{k}:{a}:{b}" for a, _, k, b in spans]
        base = [s for s, x in zip(said, spans, strict=True) if x[1] < 3]
        assert r["spans"] == ",".join(said) and r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[1] == k for x in spans) for k in range(3)]
    assert secrets.report(empty, secrets.scan(empty)).count() == 0


def test_secret_ledger_is_incremental(spark):
    docs = frame(spark, [(1, SECRETS[0]), (2, SECRETS[2]), (3, SECRETS[0])])
    first = frames.keep(secrets.scan(docs, rules=secrets.BASE[:2]))
    assert first.count() == 2  # one row a blob
    assert secrets.scan(docs, first, secrets.BASE[:2]).count() == 0
    more = docs.union(frame(spark, [(1, "new version, secret = abcdefg")]))
    second = frames.keep(secrets.scan(more, first, secrets.BASE))
    todo = {tuple(r.rules) for r in second.collect()}
    assert todo == {("hex@1",), ("assign@1", "access@1", "hex@1")}
    ledger = first.union(second)
    whole = secrets.scan(more, rules=secrets.BASE)
    key = lambda rows: sorted(map(repr, rows))
    assert key(got(secrets.report(more, ledger))) == key(got(secrets.report(more, whole)))


# --- substrings ------------------------------------------------------------


def brute_substrings(rows, size):
    words = [PLAIN.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            if seen[tuple(w[p:p + size])] > 1:
                gone[p:p + size] = [True] * size
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return Counter(out)


def test_substrings_odd(spark, odd, empty):
    out = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got(substrings.dedup(odd)))
    assert out == brute_substrings(odd_texts(), 35)
    assert substrings.dedup(empty).count() == 0


def test_substrings_random(spark):
    rng = random.Random(5)
    pool = [[f"w{rng.randint(0, 30)}" for _ in range(rng.randint(30, 60))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randint(0, 4)):
            part = list(rng.choice(pool))
            if rng.random() < 0.5:
                part = part[rng.randint(0, 10):len(part) - rng.randint(0, 10)]
            w += part + [f"u{rng.randint(0, 5)}" for _ in range(rng.randint(0, 20))]
        rows.append((i, " ".join(w)))
    out = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got(substrings.dedup(frame(spark, rows), size=20)))
    assert out == brute_substrings(rows, 20)


def test_substrings_are_cut_without_a_lookup_per_word(monkeypatch):
    rng = random.Random(7)
    texts = ["a b  c\u00a0d\té\x0b" * 3, "", " \n", " ".join(f"w{rng.randint(0, 2)}" for _ in range(200)), "x y z w v u " * 9, "only once é ü ß " + "q"]
    press = substrings.zstandard.ZstdCompressor()
    spans = [None, None, None, [{"first": 3, "n": 2}], None, [{"first": 0, "n": 1}]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(6)), pa.array([press.compress(t.encode()) for t in texts], pa.binary()), pa.array([True, False, False, False, False, False]), pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())])))],
        names=["key", "body", "copied", "spans"],
    )
    hashed = []
    hashes = substrings.Words.hashes
    monkeypatch.setattr(substrings.Words, "hashes", lambda self, which=0: hashed.append(which) or hashes(self, which))
    monkeypatch.setattr(substrings.Words, "word", None)
    out = pa.Table.from_batches(substrings._cut(4)(iter([batch]))).to_pylist()
    assert hashed == [0]
    for r, t, marked, whole in zip(out, texts, spans, [True] + [False] * 5, strict=True):
        w = PLAIN.findall(t)
        seen = Counter(tuple(w[i:i + 4]) for i in range(len(w) - 3))
        gone = [False] * len(w)
        for i in range(len(w) - 3):
            if whole or seen[tuple(w[i:i + 4])] > 1 or any(x["first"] <= i < x["first"] + x["n"] for x in marked or ()):
                gone[i:i + 4] = [True] * 4
        assert (r["n_words"], r["n_removed"]) == (len(w), sum(gone))
        assert r["kept_text"] == " ".join(x for x, g in zip(w, gone, strict=True) if not g)


# --- quality ---------------------------------------------------------------


def test_binomial_tail(spark):
    rows = [(n, k) for n in (1, 5, 40, 300, 5000) for k in (0, 1, 2, 10, 40) if k <= n]
    df = spark.createDataFrame(rows, "n bigint, k bigint").withColumn("p", quality.binomial_tail(F.col("n"), F.col("k"), 0.01))
    for r in df.collect():
        want = sum(math.exp(math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(0.01) + (r.n - i) * math.log(0.99)) for i in range(r.k + 1))
        assert r.p == pytest.approx(want if r.k <= r.n * 0.01 else 1.0, rel=1e-6)


def test_quality_measures(spark, odd, empty):
    out = got(quality.measures(odd))
    assert len(out) == len(odd_texts())
    for r in out:
        t = r["text"] or ""
        w = PLAIN.findall(t)
        win = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        hit = {i + o for i in range(len(w) - 2) if win[tuple(w[i:i + 3])] > 1 for o in range(3)}
        ls = [x for x in t.split("\n") if PLAIN.search(x)]
        want = [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(ls) - len(set(ls)), len(hit)]
        assert [r[f"__{c}"] for c in quality.COUNTS] == want
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    kept = quality.keep(odd, labels)
    assert kept.columns == odd.columns
    ok = sum(len(PLAIN.findall(t or "")) >= 50 for _, t in odd_texts()) - 1  # "a a a ..." repeats itself
    assert kept.where("length(text) < 100000").count() == ok - sum(len(t or "") >= 100000 for _, t in odd_texts())
    assert quality.keep(empty, labels).count() == 0


def test_quality_cutoffs_hold_the_risk(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    rows, labels = [], []
    for i in range(1500):
        bad = i % 5 == 0
        rows.append((i, " ".join(word() + ("###" if bad and rng.random() < 0.6 else "") for _ in range(60))))
        labels.append((i, 0 if bad else 1, 0))
    labels += [(None, 0, 0), (1, None, 0), (0, 0, 0)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = frame(spark, rows)
    tests = quality.certify(quality.measures(docs), labels)
    assert tests.where("certified AND k > n * 0.01").count() == 0
    kept = {r.doc_id for r in quality.keep(docs, labels).select("doc_id").collect()}
    assert kept == {i for i in range(1500) if i % 5}


def test_quality_strata_are_never_pooled(spark):
    """Three hundred languages: 299 with bad texts full of symbols, one whose
    good texts are, and one without labels of its own."""
    text = lambda i, odd: " ".join(f"w{i}x{j}" + ("###" if odd else "") for j in range(60))
    rows = [(i, f"l{i % 299:03d}", text(i, i % 2)) for i in range(299 * 20)]
    rows += [(10_000 + i, "zz", text(i, 1)) for i in range(5)] + [(20_000 + i, "none", text(i, 1)) for i in range(5)]
    rows += [(30_000 + i, "big", text(i, i % 3 == 0)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    good = lambda i: int(10_000 <= i < 20_000 or (i % 3 > 0 if i >= 30_000 else i % 2 == 0))
    labels = spark.createDataFrame([(i, good(i), 0) for i, lang, _ in rows if lang != "none"], "doc_id bigint, quality int, toxic int")
    tests = quality.certify(quality.measures(docs), labels)
    assert {r.stratum for r in tests.select("stratum").distinct().collect()} == {f"={lang}" for _, lang, _ in rows if lang != "none"}
    first = tests.agg(F.min("p"), F.max(F.when(F.col("certified"), F.col("p")))).first()
    assert first[0] <= 0.05 / (301 * 40) and first[1] <= 0.05 / (301 * 40)
    kept = {r.doc_id for r in quality.keep(docs, labels).select("doc_id").collect()}
    # Twenty labels certify nothing, two thousand good ones do.
    assert kept == {i for i, lang, _ in rows if lang != "big" or i % 3}


# --- decontamination -------------------------------------------------------


def brute_hits(rows, items, size=13):
    windows = defaultdict(set)
    for item, t in items:
        w = FOLDED.findall(fold(t))
        n = min(size, len(w))
        for p in range(len(w) - n + 1) if n else ():
            windows[tuple(w[p:p + n])].add(item)
    out = []
    for i, t in rows:
        w = FOLDED.findall(fold(t))
        hit, ids = set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in windows:
                    hit |= set(range(p, p + n))
                    ids |= windows[tuple(w[p:p + n])]
        ids = sorted(str(x) for x in ids if x is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return Counter(out)


def test_decontaminate(spark, odd, empty):
    rows = odd_texts()
    base = next(t for i, t in rows if i == 5)
    w = base.split()
    items = [(1, " ".join(w[10:40])), (2, "TWO"), (3, None), (4, ""), (10, "one"), (None, "wörds apart"), (2, " ".join(w[50:63])), (7, "not in any document at all")]
    bench = spark.createDataFrame([(*x, "extra") for x in items], "item_id bigint, text string, key string")
    want = brute_hits(rows, items)
    for limit in (decontaminate.MAX_WINDOWS, 3):
        out = decontaminate.report(odd, bench, max_windows=limit)
        assert Counter(tuple(r.values()) for r in got(out)) == want
        clean = decontaminate.clean(odd, bench, max_windows=limit)
        assert clean.columns == odd.columns
        assert Counter(r.doc_id for r in clean.collect()) == Counter(i for (i, *_, bad), n in want.items() if not bad for _ in range(n))
    cut = decontaminate.clean(odd, bench, spans=True)
    assert decontaminate.report(cut.where("doc_id = 8"), bench).first().n_hit == 0
    assert decontaminate.report(empty, bench).count() == 0
    assert {r.n_hit for r in decontaminate.report(odd, bench.limit(0)).collect()} == {0}


def test_decontaminate_cuts_the_same_spans_by_join(spark, odd, empty):
    base = next(t for i, t in odd_texts() if i == 5).split()
    items = [(1, "two"), (2, " ".join(base[50:53])), (3, "wörds apart"), (4, "third line")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    say = lambda df: Counter(tuple(map(str, r)) for r in df.collect())
    whole, joined = (decontaminate.clean(odd, bench, spans=True, max_windows=n) for n in (decontaminate.MAX_WINDOWS, 2))
    assert joined.schema.names == odd.schema.names and joined.schema["text"].dataType == odd.schema["text"].dataType
    want = say(whole)
    assert say(joined) == want != say(decontaminate.clean(odd, bench))
    assert decontaminate.clean(empty, bench, spans=True, max_windows=2).count() == 0


# --- language --------------------------------------------------------------


def test_language_held_out(spark):
    out = queries.QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01").join(frames.read(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang"), "doc_id")
    right, n = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.97
    assert out.where("score < 0 OR score > 1").count() == 0


def test_language_odd(spark, odd, empty):
    model = language.fit(table(spark, "documents"), F.col("doc_id"))
    out = got(language.identify(odd, model))
    assert len(out) == len(odd_texts())
    for r in out:
        assert (r["lang_pred"] == "und") in {not any(c.isalpha() for c in t or "") for i, t in odd_texts() if i == r["doc_id"]}
        assert (r["lang_pred"] == "und") == (r["score"] == 0.0) or r["score"] == 0.0
    assert language.identify(empty, model).count() == 0
    nothing = language.fit(empty, F.col("doc_id"))
    assert {r["lang_pred"] for r in got(language.identify(odd, nothing))} == {"und"}


def test_language_sample_is_bounded(spark, monkeypatch):
    """One key, or none, for all rows; a third of them equal."""
    drawn, keep = [], language._sample
    monkeypatch.setattr(language, "_sample", lambda *a: drawn.append(keep(*a)) or drawn[-1])
    texts = [(k, lang, f"{lang} word{i} and more of {i * i}") for k, lang in ((None, "aa"), (7, "bb")) for i in range(600)]
    texts += [(k, lang, "the same text") for k, lang in ((None, "aa"), (7, "bb")) for _ in range(300)] + [(9, "cc", "only one")] * 50
    model = language.fit(spark.createDataFrame(texts, "doc_id bigint, lang string, text string"), F.col("doc_id"), per_language=40)
    n = {r.lang: (r.n, r.d) for r in drawn[0].groupBy("lang").agg(F.count("*").alias("n"), F.countDistinct("text").alias("d")).collect()}
    assert n == {"aa": (40, 40), "bb": (40, 40), "cc": (1, 1)}
    assert {r.lang for r in model.table.collect()} == {"aa", "bb", "cc"}


def test_language_learns_every_language(spark):
    rng = random.Random(8)
    words = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(12)] for _ in range(300)]
    rows = [(3 * k + j, f"l{k:03d}", " ".join(rng.sample(w, 9))) for k, w in enumerate(words) for j in range(3)] + [(None, "l000", None), (-1, None, "!!!"), (None, None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    model = language.fit(docs, F.col("doc_id"))
    whole, parts = (language.identify(docs, model, held_out=F.col("doc_id") > 5, block=n) for n in (language.BLOCK, 64))
    assert whole.columns == parts.columns and 64 < model.n <= language.BLOCK
    say = lambda df: sorted((str(r.doc_id), str(r.held_out), r.lang_pred, round(r.score, 4), r.rejected) for r in df.collect())
    assert say(whole) == say(parts) and len(say(parts)) == len(rows)
    assert {r.doc_id: r.lang_pred for r in parts.where("doc_id >= 0").collect()} == {i: lang for i, lang, _ in rows if i is not None and i >= 0}


def test_language_document_frequencies_are_of_all_rows(spark):
    """A sample of ten texts a language weighs the trigrams of all."""
    rows = [(i, "aa", f"text number{i}") for i in range(200)] + [(1000 + i, "bb", f"other {i}") for i in range(30)] + [(5000, None, "qqq")]
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"), F.col("doc_id"), per_language=10)
    seen = (language.counts(pa.array([t for _, lang, t in rows if lang is not None])) > 0).sum(axis=0)
    want = np.where(seen > 0, np.log((1 + 230) / (1 + seen)) + 1, 0)
    assert np.allclose(model.idf, want, atol=1e-5)


# --- lines -----------------------------------------------------------------


def brute_lines(rows):
    """Rows as a list of (id, text); distinct ids and texts."""
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    cut = {}
    for i, t in rows:
        if t is None:
            continue
        ls, chunk, cut[i] = t.split("\n"), [], []
        for p, line in enumerate(ls):
            chunk.append(line)
            if p == len(ls) - 1 or int(md5((md5(ls[p - 1]) if p else "") + md5(line))[:8], 16) % lines.DIVISOR == 0:
                cut[i].append(chunk)
                chunk = []
    first, out = {}, {}
    for i in sorted(cut):
        for p, c in enumerate(cut[i]):
            first.setdefault(tuple(c), (i, p))
    for i, t in rows:
        out[i] = t
        if t is not None and any(len(c) >= 2 and first[tuple(c)] != (i, p) for p, c in enumerate(cut[i])):
            out[i] = "\n".join(x for p, c in enumerate(cut[i]) if len(c) < 2 or first[tuple(c)] == (i, p) for x in c)
    return out


def test_line_chunks(spark, odd, empty):
    rng = random.Random(4)
    pool = [[f"line {rng.randint(0, 60)}" for _ in range(8)] for _ in range(5)]
    rows = [(i, "\n".join(itertools.chain.from_iterable([f"own {i}.{j}", *rng.choice(pool)] for j in range(rng.randint(0, 4))))) for i in range(80)]
    rows += [(80, None), (81, "\n\n\n\n"), (82, "é\r\nb\r\n")]
    out = {r.doc_id: r for r in lines.dedup(frame(spark, rows)).collect()}
    want = brute_lines(rows)
    assert {i: r.text for i, r in out.items()} == want
    assert sum(r["__n_removed"] for r in out.values()) > 50
    again = lines.dedup(odd)
    assert again.count() == len(odd_texts()) and again.columns[:-2] == odd.columns
    assert lines.dedup(empty).count() == 0


# --- licenses --------------------------------------------------------------


def test_license_scan(spark, odd, empty):
    mit = licenses.TEMPLATES["mit"]
    w = mit.split()
    texts = [
        "Released under the MIT License.\n\nmit-license MIT  license", "GNU general\npublic LICENSE", "intro\n\n" + mit.upper() + "\n\nend", " ".join(w[: len(w) // 2]),
        " ".join(w[: int(len(w) * 0.95)]), "cc by\ncc-by cc by", "xmit license", "mit licensé", None, "", "apache", "license mit",
    ]
    rows = [*enumerate(texts), (0, texts[0])]
    out = got(licenses.scan(frame(spark, rows)))
    assert len(out) == len(rows)
    for r in out:
        words = FOLDED.findall(fold(texts[r["doc_id"]]))
        places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        # Every block against every template.
        want = []
        for block in re.split(r"\n[^\n\w]*\n", fold(texts[r["doc_id"]])):
            own = set(FOLDED.findall(block))
            for name, t in licenses.TEMPLATES.items():
                all_words = set(FOLDED.findall(fold(t)))
                if len(own & all_words) >= 0.8 * len(all_words):
                    want.append((name.partition("/")[0], len(own & all_words) / len(all_words)))
        assert Counter((b["label"], b["containment"]) for b in r["blocks"]) == Counter(want)
        assert r["labels"] == ",".join(sorted({x for _, x in places} | {x for x, _ in want}))
        assert r["score"] == (1.0 if places else max((x for _, x in want), default=0.0))
    assert licenses.scan(odd).count() == len(odd_texts()) and licenses.scan(empty).count() == 0


def test_license_scan_of_other_licenses_and_long_lines(spark):
    """Notices of other licenses, and a long line with a template's words far
    apart, hold no template; notices inside a long line do."""
    rng = random.Random(6)
    own = sorted({x for t in licenses.TEMPLATES.values() for x in FOLDED.findall(fold(t))})
    spread = " ".join(" ".join([x, *(f"filler{rng.randint(0, 99)}" for _ in range(40))]) for x in own)
    filler = " ".join(f"word{rng.randint(0, 99)}" for _ in range(3000))
    lgpl = licenses.TEMPLATES["gpl"].replace("GNU General", "GNU Lesser General")
    cases = [
        ("Released under the BSD License", ""),
        ("Licensed under the Mozilla Public License, Version 2.0", ""),
        ("Licensed under CC BY 4.0", "cc-by"),
        ("Licensed under CC BY-NC-SA 4.0", "cc-by"),
        (licenses.TEMPLATES["cc-by"].replace("Attribution", "Attribution-NonCommercial 4.0"), ""),
        (lgpl, ""),
        (spread, ""),
        (f"{filler} Released under the (MIT) Licence {filler}", "mit"),
        (f"{filler} {licenses.TEMPLATES['bsd']} {filler}", "bsd"),
        (f"{spread} licensed under terms of the Apache 2.0 license version {filler}", "apache"),
        ("Licensed under CC BY-NC 4.0", "cc-by,cc-by-nc"),
        (licenses.TEMPLATES["cc-by"], "cc-by"),
        (licenses.TEMPLATES["mpl"], "mpl"),
    ]
    out = {r["doc_id"]: r["labels"] for r in got(licenses.scan(frame(spark, [(i, t) for i, (t, _) in enumerate(cases)])))}
    assert [out[i] for i in range(len(cases))] == [want for _, want in cases]


# --- WARC ------------------------------------------------------------------


def test_warc_round_trip_and_audit(spark, tmp_path):
    pages = table(spark, "pages").union(spark.createDataFrame([(None, None, None), (900, "u", ""), (901, "u", "a\r\n\r\nb é")], "page_id bigint, url string, html string"))
    for compression in ("none", "gzip"):
        path = str(tmp_path / compression)
        warc.write_warc(pages.coalesce(2), path, compression=compression)
        back = warc.read_warc(spark, path)
        assert Counter(bytes(r.body).decode() for r in back.collect()) == Counter(r.html or "" for r in pages.collect())
    same = warc.files_archive(warc.read_warc(spark, str(tmp_path / "none")))
    assert warc.audit(same, same).count() == 0
    one = same.orderBy("file", "offset").collect()
    hit, lost = one[3], one[7]
    where = lambda r: (F.col("file") == r.file) & (F.col("offset") == r.offset)
    worse = same.where(~where(lost)).withColumn("digest", F.when(where(hit), "0").otherwise(F.col("digest")))
    worse = worse.union(spark.createDataFrame([(hit.file, 10**7, 5, "new", "1")], "file bigint, offset bigint, length bigint, key string, digest string"))
    found = {(r.file, r.offset): r.status for r in warc.audit(same, worse).collect()}
    assert found == {(hit.file, hit.offset): "corrupt", (lost.file, lost.offset): "missing", (hit.file, 10**7): "extra"}
    none = same.limit(0)
    assert warc.audit(none, none).count() == 0
    assert {r.status for r in warc.audit(same, none).collect()} == {"missing"}


def test_warc_files_of_any_name_with_damage(spark, tmp_path):
    one = lambda i: f"WARC/1.0\r\nWARC-Record-ID: <r{i}>\r\nContent-Length: 40\r\n\r\n{i:040d}".encode()
    end, size = b"\r\n\r\n", len(one(0)) + 4
    names = ["CC-MAIN-a.warc", "CC-MAIN-b.warc", "part-00000-x.c000", "part-00000-x.c001"]
    plain = {n: [one(10 * k + i) + end for i in range(5)] for k, n in enumerate(names)}
    zipped = {"CC-MAIN-c.warc.gz": gzip.compress(b"".join(one(70 + i) + end for i in range(5)), mtime=0), "CC-MAIN-d.warc.gz": b"".join(gzip.compress(one(80 + i) + end, mtime=0) for i in range(5))}
    sides = []
    for side in ("primary", "replica"):
        (tmp_path / side).mkdir()
        for n, parts in plain.items():
            raw = b"".join(parts)
            if side == "replica":
                if n == "CC-MAIN-a.warc":
                    continue  # lost as a whole
                if n == "CC-MAIN-b.warc":
                    raw = raw.replace(b"WARC/", b"XARC/", 2).replace(b"XARC/", b"WARC/", 1)  # the second header
                if n.endswith("c001"):
                    raw = raw[: size * 2] + raw[size * 2:].replace(b"Content-Length: 40", b"Content-Length: 99", 1)
            (tmp_path / side / n).write_bytes(raw)
        for n, raw in zipped.items():
            if side == "replica" and "-c" in n:
                raw = raw[:-20]  # torn
            if side == "replica" and "-d" in n:
                at = raw.index(b"\x1f\x8b\x08", 1)
                raw = raw[: at + 10] + b"\xff" * 8 + raw[at + 18:]
            (tmp_path / side / n).write_bytes(raw)
        sides.append(warc.read_warc(spark, str(tmp_path / side)))
    assert sides[0].where("body IS NULL").count() == 0 and sides[0].count() == 30
    same = warc.files_archive(sides[0])
    assert same.count() == 30 == same.select("file", "offset").distinct().count() and same.agg(F.max("file")).first()[0] == 5
    found = {(r["name"], r.offset // size): r.status for r in warc.audit_files(*sides).collect() if "-c.warc" not in r["name"]}
    want = {("CC-MAIN-a.warc", i): "missing" for i in range(5)}
    want |= {("CC-MAIN-b.warc", 1): "corrupt", ("part-00000-x.c001", 2): "corrupt", ("CC-MAIN-d.warc.gz", 1): "corrupt"}
    assert found == want
    torn = [r for r in warc.audit_files(*sides).collect() if "-c.warc" in r["name"]]
    assert torn and all(r.status in ("missing", "corrupt", "extra") for r in torn)
    assert warc.audit_files(sides[0], sides[0]).count() == 0
    none = sides[0].limit(0)
    assert warc.audit_files(none, none).count() == 0
    assert Counter(r.status for r in warc.audit_files(sides[0], none).collect()) == {"missing": 30}


def test_warc_archive(spark):
    pages = table(spark, "pages").withColumn("key", F.lit(1)).withColumn("file", F.lit("x"))
    rows = warc.archive(pages, file_bytes=20_000).collect()
    assert len(rows) == pages.count()
    files = defaultdict(list)
    for r in rows:
        files[r.file].append((r.offset, r.length))
    assert len(files) > 1
    for spans in files.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
    assert warc.archive(pages.limit(0)).count() == 0


def test_minhash_estimates_similarity():
    import pyarrow as pa

    words = [f"t{i}" for i in range(1000)]
    texts = pa.array([" ".join(words), " ".join(words[:900] + [f"z{i}" for i in range(100)])])
    s = minhash.Shingles(texts, 1)
    a, b = s.signatures(np.arange(2))
    assert abs((a == b).mean() - 900 / 1100) < 0.12
