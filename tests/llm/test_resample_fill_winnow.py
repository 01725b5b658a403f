"""Importance resampling, fill-in-middle and decontamination against brute force, on odd rows too."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrace.llm import fill_middle, importance, winnow
from terrace.llm.fill_middle import FillRules, fill_in_middle, restored
from terrace.llm.importance import ImportanceRules, resample
from terrace.llm.winnow import WinnowRules, find_leaks

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EXTRA = dict(score=1.5, size="s", _text="t", _key=1, _row=2, item="i", n_words=3, start=0, hash=1, rank=1, form="f", n=9, bucket=1)

rng = random.Random(11)
PROSE = [" ".join(rng.choice("the of river Stone cloud 7 é ñandú Straße ΣΑΣ".split()) for _ in range(n)) for n in (25, 40, 60, 9, 200)]
PASSAGE = "Alpha beta gamma; delta epsilon zeta eta theta iota kappa lambda mu"
TEXTS = [
    None, "", " ", "\n\n", "word", "one two", "a\x00b\x00c", *PROSE, PROSE[1], PROSE[1], "x" * 5000, "a " * 400,
    f"{PROSE[0]} {PASSAGE.upper()} {PROSE[1]}", " ".join(PASSAGE.split()[1:11]), " ".join(PASSAGE.split()[:9]),
    f"{PASSAGE} {PASSAGE}", "has <S> in it " * 30, "é😀 a@b.co 🙂 ١٢٣ don't\n$1 \\2 {3}+", "short item here and SHORT Item",
    " ".join(f"w{i}" for i in range(30_000)),
]
ITEMS = [(1, PASSAGE), (2, " ".join(PASSAGE.split()[2:])), (10, "short item"), (3, None), (4, ""), (5, "a " * 11), (None, "x" * 5000), (6, PROSE[4]), (6, "river")]


@pytest.fixture(scope="module")
def odd(spark):
    # ids that repeat with other and with the same text, and null ids
    ids = [k if k not in (3, 9) else None for k in range(len(TEXTS))]
    rows = [*zip(ids, TEXTS, strict=True), (5, "one two"), (5, PROSE[2]), (None, PROSE[2]), (None, PROSE[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.withColumns({k: F.lit(v) for k, v in EXTRA.items()}).withColumn("a.b", F.lit(1)).cache()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumns(
        {k: F.lit(v) for k, v in EXTRA.items()}).cache()


def words(text):
    return WORD.findall((text or "").translate(LOW))


def spread(rows):
    return sorted(map(repr, rows))


def parts(seed, key):
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


# fill-in-middle


def cut_by_hand(key, text, rules=FillRules()):
    t = text or ""
    h = parts(rules.seed, key)
    n = len(t)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (key, n, "plain", None, None, t)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    if h[3] % 100 < 20:
        return (key, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}")
    return (key, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle(odd):
    got = [tuple(r) for r in fill_in_middle(odd).collect()]
    want = [cut_by_hand(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert spread(got) == spread(want) and {f for _, _, f, *_ in got} == {"plain", "spm", "psm"}
    assert fill_in_middle(odd.limit(0)).count() == 0


def test_restored(odd):
    seeds = fill_in_middle(odd)
    for seed in "23456":
        seeds = seeds.unionByName(fill_in_middle(odd, rules=FillRules(seed=seed)))
    back = Counter(r[0] for r in seeds.select(restored(F.col("output"), F.col("form"))).collect())
    assert back == {t: 6 * n for t, n in Counter(r.text or "" for r in odd.select("text").collect()).items()}


def test_fill_in_middle_of_long_texts(spark):
    text = "Aé😀\n" * 500_000
    df = spark.createDataFrame([(k, text[k:]) for k in range(3)], "doc_id long, text string")
    got = {r.doc_id: r for r in fill_in_middle(df).collect()}
    for k in range(3):
        assert tuple(got[k]) == cut_by_hand(k, text[k:])


def test_fill_in_middle_by_words(spark):
    rules = FillRules(unit=r"(?:\s*\S+\s*)", prefix="$1", suffix="\\S", middle="^M", block=3)
    text = " one two  three\nfour five six seven "
    df = spark.createDataFrame([(k, text) for k in range(40)], "doc_id long, text string")
    out = fill_in_middle(df, rules=rules).withColumn("back", restored(F.col("output"), F.col("form"), rules)).collect()
    assert {r.n for r in out} == {7} and {r.back for r in out} == {text}
    one = next(r for r in out if r.form == "psm")
    assert one.output.startswith("$1") and "\\S" in one.output and one.n_prefix + one.n_middle <= 7


# decontamination


def leaks_by_hand(docs, benchmark, span=10):
    windows = {}
    for item, text in benchmark:
        w = words(text)
        k = min(len(w), span)
        for s in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[s:s + k]), set()).add("" if item is None else str(item))
    sizes = {len(x) for x in windows}
    out = []
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in windows:
                    hit |= set(range(s, s + k))
                    found |= windows[tuple(w[s:s + k])]
        out.append((key, len(w), len(hit), sorted(found)))
    return out


def test_find_leaks(odd, items):
    got = find_leaks(odd, items).collect()
    want = leaks_by_hand([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()], ITEMS)
    assert spread((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == spread(want)
    for r in got:
        assert r.n_hit == sum(s.end - s.start for s in r.spans)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))
    assert max(r.n_hit for r in got) == 400 and sum(r.n_hit == 0 for r in got) > 5


def test_find_leaks_of_empty_tables(odd, items):
    assert find_leaks(odd.limit(0), items).count() == 0
    got = find_leaks(odd, items.limit(0)).collect()
    assert len(got) == odd.count() and not any(r.n_hit or r["items"] or r.spans for r in got)


@pytest.mark.parametrize("limit", ["-1", "10m"])
def test_find_leaks_with_and_without_broadcast(spark, limit):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcdefg") for _ in range(n))
    docs = [(k, text(rng.choice([0, 5, 12, 60, 300]))) for k in range(60)]
    benchmark = [(k, text(n)) for k, n in enumerate([1, 3, 4, 6, 7, 9, 10, 11, 30, 80])]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        for span in (6, 5, 10):
            mine = benchmark[5:] if span == 10 else benchmark[3:] if span == 6 else benchmark[1:]
            got = find_leaks(spark.createDataFrame(docs, "doc_id int, text string"),
                             spark.createDataFrame(mine, "item_id int, text string"), rules=WinnowRules(span=span))
            want = leaks_by_hand(docs, mine, span)
            assert spread((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()) == spread(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_places_beyond_the_packed_ones(spark, monkeypatch):
    monkeypatch.setattr(winnow, "PLACE_BITS", 3)
    monkeypatch.setattr(winnow, "FIRST", 8)
    docs = [(1, f"{PROSE[4]} {PASSAGE} {PROSE[2]} {PASSAGE} {PROSE[0]}"), (2, PROSE[4])]
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                     spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")).collect()
    assert spread((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == spread(leaks_by_hand(docs, [(1, PASSAGE)]))


def test_winnowing_keeps_a_gram_of_every_shared_run(spark):
    rng = random.Random(4)
    shared = [f"s{i}" for i in range(8)]
    for size in range(1, 9):
        rows = [([f"{side}{rng.random()}" for _ in range(rng.randrange(6))] + shared[:size] + [f"{side}x"] * rng.randrange(6),)
                for side in "ab" for _ in range(8)]
        kept = spark.createDataFrame(rows, "w array<string>").select(
            F.transform(winnow.kept_grams(F.col("w"), size), winnow.gram_hash)).collect()
        assert all(set(a[0]) & set(b[0]) for a in kept[:8] for b in kept[8:])


# importance resampling


def resampled_by_hand(docs, target, rules):
    def feats(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % rules.buckets
                for n in range(rules.shortest, rules.longest + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(feats(text))
    for text in target:
        t.update(feats(text))
    total_s, total_t = sum(s.values()) + rules.buckets, sum(t.values()) + rules.buckets
    out = []
    for key, text in docs:
        f = feats(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * total_s / ((s[b] + 1) * total_t))) for b in f]
        weight = sum(gain) // len(gain) if gain else 0
        noise = math.floor(-1000 * math.log(-math.log((parts(rules.seed, key)[0] + 0.5) / 4294967296)))
        out.append([key, len(words(text)), len(f), weight, weight + noise, None])
    able = sorted((r for r in out if r[1] >= rules.min_words),
                  key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(able[:rules.share_pct * len(able) // 100]):
        r[5] = k + 1
    return out


@pytest.mark.parametrize("rules", [
    ImportanceRules(longest=1), ImportanceRules(), ImportanceRules(shortest=2, longest=3, buckets=101, min_words=0, share_pct=60),
    ImportanceRules(longest=1, min_words=0, share_pct=100)])
def test_resample(odd, items, rules):
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = spread(tuple(r) for r in resample(odd, items, rules=rules).collect())
    assert got == spread(map(tuple, resampled_by_hand(docs, [t for _, t in ITEMS], rules)))
    assert got == spread(tuple(r) for r in resample(odd.repartition(5), items, rules=rules).collect())


def test_resample_of_empty_tables(odd, items):
    assert resample(odd.limit(0), items).count() == 0
    got = [tuple(r) for r in resample(odd, items.limit(0)).collect()]
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert spread(got) == spread(map(tuple, resampled_by_hand(docs, [], ImportanceRules())))


def test_resample_with_a_hot_key(spark):
    # a third of all rows have no id, and most of these agree in all columns
    docs = [(None, PROSE[0])] * 300 + [(None, PROSE[4])] * 50 + [(k, PROSE[k % 5]) for k in range(700)]
    rules = ImportanceRules(share_pct=45)
    got = resample(spark.createDataFrame(docs, "doc_id long, text string"),
                   spark.createDataFrame([(PROSE[1],)], "text string"), rules=rules)
    assert spread(tuple(r) for r in got.collect()) == spread(map(tuple, resampled_by_hand(docs, [PROSE[1]], rules)))


def test_features_of_texts_read_in_pieces():
    texts = [b"", b"One two three four", b"\x00five\x00six", b"w" * 300, b"", b"a b c d e f g h i j " * 20, b"last"]
    rules = ImportanceRules(longest=3)
    want = None
    for piece in (1, 2, 7, 50, 1 << 20):
        per = [Counter() for _ in texts]
        n_words = Counter()
        for buckets, owners, word_owners in importance.features(texts, importance.Buckets(rules.buckets), rules, piece):
            for b, o in zip(buckets.tolist(), owners.tolist(), strict=True):
                per[o][b] += 1
            n_words.update(word_owners.tolist())
        want = want or (per, n_words)
        assert (per, n_words) == want
    w = [words(t.decode()) for t in texts]
    assert [n_words[k] for k in range(len(texts))] == [len(x) for x in w]
    assert [sum(c.values()) for c in per] == [sum(max(0, len(x) - n) for n in range(3)) for x in w]


def test_a_full_memory_of_buckets_forgets(monkeypatch):
    monkeypatch.setattr(importance, "CACHED", 3)
    memo = importance.Buckets(1000)
    seen = [memo[b"%d" % (k % 7)] for k in range(70)]
    assert seen == [zlib.crc32(b"%d" % (k % 7)) % 1000 for k in range(70)] and len(memo) <= 3
    assert memo[importance.SENTINEL] == -1


def test_markers_and_hashes_are_those_of_the_contract():
    assert (fill_middle.FillRules().prefix, fill_middle.FillRules().suffix, fill_middle.FillRules().middle) == ("<P>", "<S>", "<M>")
