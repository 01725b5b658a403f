"""Corpus operators against brute force, on odd rows and on a small table."""

import hashlib
import random
import re
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from terrace.llm import bpe, html_text, license_scan, line_rules, mixing, near_copies, piecewise_hash, private_data, simhash
from terrace.llm import token_counts, toxicity
from terrace.llm.components import components

BLANK_WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

rng = random.Random(5)
LONG = " ".join(rng.choice("the of and lion river stone cloud 7 é ñandú Straße".split()) for _ in range(9000))
TEXTS = [
    None, "", " ", "\n\n", "word", "one two", "one two three", "a b c a b c a b c", LONG, LONG, LONG + " end",
    "Released under CC BY-NC 4.0. All rights reserved. all Rights  reserved",
    "licensed under the GNU General Public License, version 3", "cc by cc by", "permission is hereby granted, free of charge,",
    "mail a.b@c-d.org or x@y.z._q@r.s now", "4111 1111 1111 1111, 10.0.0.1 and 1.2.3.4.5.6.7.8", "+1 (017) 555-7713 999.1.1.1",
    "é😀 a@b.co 🙂 ١٢٣ <|endoftext|>x don't ΣΑΣ", "x" * 5000, "line\nline\nline\nother", "1" * 400 + "@",
]
EXTRA = dict(score=1.5, size="s", _text="t", _key=1, fp=2, ids="i", n_words=3, label=0, component_id=4, copies=9, hash=1)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k if k != 4 else None, t, f"s{k % 3}" if k % 5 else None) for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    df = df.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({k: F.lit(v) for k, v in EXTRA.items()}).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def texts():
    return {(k if k != 4 else None): t or "" for k, t in enumerate(TEXTS)}


def rows_of(df, key="doc_id"):
    rows = df.collect()
    by = {r[key]: r for r in rows}
    assert len(by) == len(rows) == len(TEXTS)
    return by


def test_license_scan(odd, none, texts):
    for k, r in rows_of(license_scan.scan(odd)).items():
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", texts[k].translate(LOW))
        places = [(i, label) for label, phrase in license_scan.BASE for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert license_scan.scan(none).count() == 0
    twice = license_scan.scan(odd.where("doc_id = 11").unionByName(odd.where("doc_id = 11")))
    assert twice.count() == 2 and twice.distinct().count() == 1


def test_diagonals_bear_inserted_and_missing_words(spark):
    df = spark.createDataFrame([
        (1, "Permission is hereby granted free of any charge to any person obtaining a copy of this software"),
        (2, "the license is general and public")], "doc_id int, text string")
    got = {r.doc_id: r.labels for r in license_scan.scan(df).collect()}
    assert got == {1: "mit", 2: ""}


def test_line_rules(odd, none, texts):
    for k, r in rows_of(line_rules.clean_lines(odd)).items():
        words = BLANK_WORD.findall(texts[k])
        windows = list(zip(words, words[1:], words[2:], strict=False))
        seen = Counter(windows)
        covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
        full = [x for x in texts[k].split("\n") if BLANK_WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", texts[k])) and r.n_dup_lines == len(full) - len(set(full))
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (r.kept and r.base_failed)
    assert line_rules.clean_lines(none).count() == 0


def test_line_rules_verdict(spark):
    prose = "This is a plain sentence with some words in it. " * 8
    menu = "Home | News | Sport | About us\n" * 40
    df = spark.createDataFrame([(1, prose), (2, prose + "\n" + "word | " * 200), (3, prose + "\nClick here"),
                                (4, menu)], "doc_id int, text string")
    rules = line_rules.LineRules(max_repeat_pct=101)
    got = {r.doc_id: r for r in line_rules.clean_lines(df, rules=rules).collect()}
    assert [got[k].kept for k in (1, 2, 3, 4)] == [True, False, True, False]
    assert "Click" not in got[3].clean_text


def test_repeats_after_a_hash_collision(spark, monkeypatch):
    monkeypatch.setattr(line_rules, "_POS_BITS", 60)  # four bits of hash are left
    df = spark.createDataFrame([(1, "a b c d e f a b c g h i j k l m n o p q r s t u v w x y z a b c")], "doc_id int, text string")
    assert line_rules.clean_lines(df).first().n_repeat_words == 9


def test_mixing(odd, none, texts):
    out = rows_of(mixing.mix(odd))
    sizes = {k: len(BLANK_WORD.findall(t)) for k, t in texts.items()}
    assert {k: r["size"] for k, r in out.items()} == sizes
    assert all(r.taken == r.copies * r["size"] and 0 <= r.copies <= 2 for r in out.values())
    assert sorted(mixing.mix(odd.repartition(5)).collect(), key=str) == sorted(mixing.mix(odd).collect(), key=str)
    assert mixing.mix(none).count() == 0


def test_mix_meets_its_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    per = {}
    for r in rows:
        s = per.setdefault(r.source, dict(size=0, target=r.target, taken=0))
        s["size"] += r["size"]
        s["taken"] += r.taken
    names, total = sorted(per), 1.5 * sum(s["size"] for s in per.values())
    weight = {n: (5, 2, 1)[k % 3] for k, n in enumerate(names)}
    free, left, want = set(names), total, {}
    while free:
        over = [n for n in free if left * weight[n] / sum(weight[m] for m in free) > 2 * per[n]["size"]]
        if not over:
            want |= {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
            break
        for n in over:
            want[n] = 2 * per[n]["size"]
        free -= set(over)
        left = total - sum(want.values())
    for n in names:
        assert per[n]["target"] == pytest.approx(want[n])
        assert per[n]["taken"] == pytest.approx(want[n], rel=0.05)


def test_mix_of_repeated_and_null_ids(spark):
    rows = [(None, "a", "w " * 7)] * 300 + [(5, "b", "w " * 11)] * 200 + [(k % 3, "c", "w " * (3 + k % 5)) for k in range(90)]
    rows += [(100 + k, s, "w " * (1 + k)) for s in "abc" for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.copies(mixing.measured(df, "doc_id", "source", "text")).collect()
    assert len(out) == len(rows) and all(0 <= r.copies <= 2 for r in out)
    for name in "abc":
        own = [r for r in out if r._src == "0" + name]
        assert abs(sum(r.copies * r["size"] for r in own) - own[0].target) < max(r["size"] for r in own)


def test_one_move_changes_one_of_equal_rows(spark):
    df = spark.createDataFrame([(None, "0a", 5, 0, k + 1, 50, 55.0, 1.1, 1) for k in range(10)],
                               "_key long, _src string, size long, _cell long, _place int, source_size long, "
                               "target double, rate double, copies int")
    assert sum(r.copies for r in mixing.settle(df, mixing.MixRules()).collect()) == 11


@pytest.mark.parametrize("limit", [64, 1])
def test_simhash(odd, none, texts, limit):
    out = rows_of(simhash.near_duplicates(odd, rules=simhash.SimhashRules(pair_limit=limit)))
    prints = {}
    for k, t in texts.items():
        words = BLANK_WORD.findall(t.translate(LOW))
        runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(x, 42) for x in runs]
        prints[k] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert out[k].fingerprint == f"{prints[k]:016x}"
    for k in texts:
        reach, todo = {k}, [k]
        while todo:
            a = todo.pop()
            near = [b for b in texts if b not in reach and (prints[a] ^ prints[b]).bit_count() <= 2]
            reach |= set(near)
            todo += near
        assert out[k].component_id == min((x for x in reach if x is not None), default=None)
    assert simhash.near_duplicates(none).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_bpe_and_token_counts(odd, none, texts):
    library = Tokenizer.from_file(VOCABULARY)
    coded, counted = rows_of(bpe.encode(odd, VOCABULARY)), rows_of(token_counts.count_tokens(odd, VOCABULARY))
    for k, t in texts.items():
        want = library.encode(t, add_special_tokens=False).ids
        assert coded[k].ids == want and coded[k].decoded == library.decode(want, skip_special_tokens=False)
        assert (counted[k].n_tokens, counted[k].n_bytes) == (len(want), len(t.encode()))
        assert counted[k].over_limit == (len(want) > 2048)
    assert bpe.encode(none, VOCABULARY).count() == token_counts.count_tokens(none, VOCABULARY).count() == 0


def test_splicing_and_long_words():
    with open(VOCABULARY, encoding="utf-8") as file:
        spec = file.read()
    library, counter, own = Tokenizer.from_str(spec), token_counts.Counter(spec), bpe.Bpe(spec)
    for text in (LONG, "ab" * 300 + " c", "abc " * 200 + "x" * 700 + " y z" * 90, "q" * 900, "", "a\n" * 400):
        want = library.encode(text, add_special_tokens=False).ids
        assert counter.huge(text, 40, 3) == counter.huge(text, 300, 16) == len(want)
        assert array("i", own.encode(text)).tolist() == want
    word = [own.inner[b] for b in b"thereisnospaceinthiswordatall" * 9]
    assert own.merge_short(list(word)) == own.merge_long(list(word))


def test_every_character_is_encoded_as_by_the_library():
    with open(VOCABULARY, encoding="utf-8") as file:
        spec = file.read()
    library, own = Tokenizer.from_str(spec), bpe.Bpe(spec)
    some = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 13 == 0)]
    encoded = library.encode_batch_fast([f"a{c}b" for c in some], add_special_tokens=False)
    assert [c for c, e in zip(some, encoded, strict=True) if array("i", own.encode(f"a{c}b")).tolist() != e.ids] == []


def test_piecewise_hash(spark, odd, none, texts):
    order = [None, *sorted(k for k in texts if k is not None)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in (1, 6):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            out = rows_of(piecewise_hash.edited_pairs(odd))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        for k, following in zip(order, [*order[1:], order[0]], strict=True):
            edited = piecewise_hash.edit(texts[k], texts[following])
            marks = [piecewise_hash.fingerprints_of([t.encode()])[0] for t in (texts[k], edited, texts[following])]
            assert out[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert [out[k].fingerprint, out[k].edited_fingerprint] == marks[:2] and out[k].n_chars == len(texts[k])
            assert out[k].near_edited == piecewise_hash.likeness(*marks[:2])
            assert out[k].near_next == piecewise_hash.likeness(marks[0], marks[2])
    assert piecewise_hash.edited_pairs(none).count() == 0
    assert piecewise_hash.fingerprint(odd).count() == len(TEXTS)


def test_likeness_follows_content():
    words = [f"w{rng.randrange(10**6)}" for _ in range(900)]
    a, b = " ".join(words), " ".join([*words[:400], "new", *words[400:]])
    c = " ".join(f"v{rng.randrange(10**6)}" for _ in range(900))
    fa, fb, fc, fh = piecewise_hash.fingerprints_of([a.encode(), b.encode(), c.encode(), a[:len(a) // 2].encode()])
    assert piecewise_hash.likeness(fa, fb) > 0.9 and piecewise_hash.likeness(fa, fc) < 0.2
    assert 0.3 < piecewise_hash.likeness(fa, fh) < 1 and piecewise_hash.likeness(fa, fa) == 1


def base_spans(text):
    patterns = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
                ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
    out = []
    for rank, (kind, pattern) in enumerate(patterns):
        for m in re.finditer(pattern, text):
            d = [int(c) for c in m[0] if c.isdigit()]
            luhn = sum(x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(reversed(d))) % 10 == 0
            if not (kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "phone" and not 9 <= len(d) <= 15
                    or kind == "card" and not (12 <= len(d) <= 19 and luhn)):
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def test_private_data(odd, none, texts):
    for k, r in rows_of(private_data.find(odd)).items():
        assert [tuple(s) for s in r.base] == base_spans(texts[k])
        assert set(r.base) <= set(r.spans)
    masked = rows_of(private_data.mask(odd))
    assert masked[15].text == "mail [EMAIL] or [EMAIL][EMAIL] now" or "@" not in masked[15].text
    assert masked[16].text == "[CARD], [IP] and [IP].[IP]" and masked[0].text is None
    assert private_data.mask(odd).columns == odd.columns and private_data.find(none).count() == 0


def test_work_on_a_huge_text_without_blanks():
    library = Tokenizer.from_file(VOCABULARY)
    draw = random.Random(3)
    for text in ("".join(draw.choices("的一是不了人我在有他这", k=150_000)), "Zm9vYmFy" * 20_000 + " end " + "x1" * 40_000):
        counter, seen = token_counts.Counter(library.to_str()), []
        starts = counter.starts
        counter.starts = lambda part: (seen.append(len(part)), starts(part))[1]  # noqa: B023
        assert counter.huge(text) == len(library.encode(text, add_special_tokens=False).ids)
        assert sum(seen) < 12 * len(text)


def test_contexts_find_unseen_identifiers(spark):
    seen = [(k, f"you can call me at +49 30 {k}123 4567 now") for k in range(7)]
    df = spark.createDataFrame([*seen, (20, "you can call me at 030-1234567 now"), (21, "it costs 123456789 in all"),
                                (22, "you can call me at 030-1234567 now")], "doc_id int, text string")
    more = {r.doc_id: [s.kind for s in r.spans if s not in r.base] for r in private_data.find(df).collect()}
    assert more[20] == more[22] == ["phone"] and more[21] == [] and not any(more[k] for k in range(7))
    assert [r.text for r in private_data.mask(df).where("doc_id = 20").collect()] == ["you can call me at [PHONE] now"]


def test_contexts_find_identifiers_of_other_shapes(spark):
    phones = [(k, f"Please call me at +49 30 {k}123 4567 now") for k in range(7)]
    mails = [(10 + k, f"so write to anna{k}@mail.example.org today") for k in range(7)]
    unseen = {"(030) 123 45 67": "phone", "555 0199": "phone", "030-1234567": "phone", "jane.doe (at) example (dot) org": "email",
              "jane at example dot org": "email", "jane@localhost": "email", "user77@intranet": "email"}
    put = [(20 + k, f"Please call me at {x} now" if kind == "phone" else f"so write to {x} today")
           for k, (x, kind) in enumerate(unseen.items())]
    clean = [(40, "it costs 1234567 in all, see page 555 0199 there"), (41, "look at that dot on the wall"), (42, "room 12 at 30")]
    df = spark.createDataFrame([*phones, *mails, *put, *clean], "doc_id int, text string")
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s not in r.base] for r in private_data.find(df).collect()}
    for k, text in put:
        x = list(unseen)[k - 20]
        assert found[k] == [(unseen[x], text.index(x), text.index(x) + len(x))], text
    assert not any(found[k] for k, _ in phones + mails + clean)
    hidden = {r.doc_id: r.text for r in private_data.mask(df.withColumn("a.b", F.lit(1))).collect()}
    assert {hidden[k] for k, _ in put} == {"Please call me at [PHONE] now", "so write to [EMAIL] today"}


def test_private_data_in_pieces(spark):
    draw = random.Random(7)
    words = ["call", "+1 (017) 555-7713", "a.b@c-d.org", "10.0.0.1", "4111 1111 1111 1111", "1.2.3.4.5", "at", "é😀", "12 34",
             "x (at) y (dot) org", "+49 30 123", "17,", "end.", "\n", "-", "(030)", "99 ", "+", "@", "dot"]
    texts = [" ".join(draw.choice(words) for _ in range(n)) for n in (50, 900, 4000)]
    texts += [" ".join(["12 34"] * 3000), "+1 2345678901 " * 400, "z" * 5000 + " a@b.co", "1.2.3.4 " * 700, ", ".join(["12 34"] * 20_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in private_data.find(df).collect():
        assert [tuple(s) for s in r.base] == base_spans(texts[r.doc_id])
    parts = df.select("doc_id", F.explode(private_data.pieces(F.col("text"))).alias("p")).select("doc_id", "p.*").collect()
    for k, t in enumerate(texts):
        own = [p for p in parts if p.doc_id == k]
        assert "".join(p.text for p in own) == t
        assert all(t[p.at:p.at + len(p.text)] == p.text and t[:p.at].endswith(p.before) for p in own)
        assert k in (3, 4, 5, 6) or max(len(p.text) for p in own) < 3000


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/a>One</a></li></ul></nav><div class="cookie-notice"><p>{w}</p></div>
{open}<h1>Head &amp; tail</h1><p>{w} one&nbsp;two<br>three</p><p>Short.</p><!-- <p>not</p> --><p>{w} last{close}
<aside><p>{w}</p></aside><section id="comments"><p>{w} said a reader</p></section>
<form><p>{w}</p><input value="x>y"></form><footer>&copy; bye</footer></body></html>"""


@pytest.mark.parametrize("open_,close", [("<article>", "</article>"), ("<div>", "</p></div>"), ("", "</p>")])
def test_html_text(open_, close):
    w = "some plain words of an article " * 4
    got = html_text.main_text(PAGE.format(w=w, open=open_, close=close))
    assert got == f"Head & tail\n{w}one two three\nShort.\n{w}last"


@pytest.mark.parametrize("wrapper", [
    'div class="content-sidebar-wrap"', 'div class="layout has-sidebar"', 'div class="no-sidebar"',
    'div class="main-widget area"', 'div class="ad"', "form action=/x", "fieldset"])
def test_wrappers_keep_their_article(wrapper):
    w = "some plain words of an article " * 4
    name = wrapper.split()[0]
    page = f"<body><nav>Menu</nav><{wrapper}><main><p>{w}</p></main><div class=sidebar><p>{w}</p></div></{name}></body>"
    assert html_text.main_text(page) == w.strip()


@pytest.mark.parametrize("label", ["content-sidebar-wrap", "layout has-sidebar", "no-sidebar", "main-widget area"])
def test_layout_names_are_whole_tokens(label):
    w = "some plain words of an article " * 4
    assert html_text.main_text(f'<body><div class="{label}"><p>{w}</p></div><div class="sidebar"><p>{w}</p></div>') == w.strip()


@pytest.mark.parametrize("label", [
    "page no-ads", "post share-enabled", "has-cookie-consent", "entry social-science", "story related-work",
    "content notice-board", "widget", "comments", "adWrapper"])
def test_a_wrapper_keeps_the_page_whatever_its_name(label):
    w = "some plain words of an article " * 4
    body = "".join(f"<p>{w}{k}</p>" for k in range(3))
    want = "\n".join(f"{w}{k}" for k in range(3))
    for before, after in (("", ""), ("<nav>Menu of the site</nav><h1>Head</h1>", "<footer>Bye</footer>")):
        page = f'<body>{before}<div class="{label}">{body}</div>{after}</body>'
        assert html_text.main_text(page) == ("Head\n" if before else "") + want
    assert html_text.main_text(f"<form action=/x><div>{body}</div><p>Short.</p></form>") == want + "\nShort."


@pytest.mark.parametrize("label", [
    "sidebar-right", "widget-area", "reader-comments", "comment-body", "comments-wrapper", "user-comments",
    "entry-comments", "main-footer", "footer-widgets", "modal-dialog", "cookie-banner", "related-posts",
    "newsletter-signup-form", "ad-300x250", "adSlot", "shareButtons", "side-bar left"])
def test_named_furniture_is_left_out(label):
    w = "some plain words of an article " * 4
    block = f'<div class="{label}"><p>{w} aside</p><p>{w} aside</p></div>'
    body = f"<p>{w}1</p><p>{w}2</p>"
    for page in (f"<body>{block}<div>{body}</div></body>", f"<body><div>{body}</div>{block}</body>", f"<main>{body}{block}</main>",
                 f'<div class="page has-sidebar">{body}{block}</div>', f"<article>{body}</article>{block}"):
        assert html_text.main_text(page) == f"{w}1\n{w}2"


def test_prose_with_a_furniture_word_in_its_name_stays():
    w = "some plain words of an article " * 4
    for label in ("related-work", "social-history", "menu-engineering", "ad-hoc", "is-search"):
        page = f'<article><p>{w}1</p><div class="{label}"><p>{w}2</p></div><p>{w}3</p></article>'
        assert html_text.main_text(page) == "\n".join(f"{w}{k}" for k in (1, 2, 3))


def test_comments_longer_than_the_article():
    w = "some plain words of an article " * 4
    talk = "".join(f"<article><p>{w} says reader {k}</p></article>" for k in range(9))
    assert html_text.main_text(f'<div><p>{w}</p></div><section id="comments">{talk}</section>') == w.strip()
    assert html_text.main_text(f'<article><p>{w}</p></article><div class="comment-list">{talk}</div>') == w.strip()


def test_windows_against_brute_force():
    rng = random.Random(12)
    rules = html_text.BlockRules()
    for _ in range(300):
        lines = [(rng.choice(["word", "word " * 9, "word " * 30]).strip(), rng.random() < 0.4) for _ in range(rng.randrange(1, 14))]
        page = "".join(f"<p><a>{t}</a></p>" if link else f"<p>{t}</p>" for t, link in lines)
        weights = [0 if link else len(t) for t, link in lines]
        need = min(rules.surge, max(weights))
        kept = set()
        # every stretch of lines between two dives (three lines without text) that somewhere surges
        for k in range(len(lines)):
            if need and sum(weights[k:k + 3]) >= need:
                low = k
                while low and weights[low - 1]:
                    low -= 1
                high = k
                while high < len(lines) and any(weights[high:high + 3]):
                    high += 1
                rows = [j for j in range(low, high)]
                while rows and not weights[rows[0]]:
                    rows.pop(0)
                while rows and not weights[rows[-1]]:
                    rows.pop()
                kept.update(rows)
        assert html_text.main_text(page) == "\n".join(lines[j][0] for j in sorted(kept)), lines


def test_very_long_and_deep_pages():
    w = "some plain words of an article " * 4
    deep = "<form>" * 4000 + f"<p>{w}</p>" + "</form>" * 4000
    assert html_text.main_text(deep) == w.strip()
    long = "".join(f"<p>{w}{k}</p><div class=ad>{w}</div>" for k in range(20_000))
    assert html_text.main_text(long).count("\n") == 19_999


def test_short_lines_around_a_surge():
    head, by, day, para = "A headline of thirty letters..", "By Jane Doe.", "1 May 2020", "some plain words " * 18
    links = "".join(f"<p><a href=/{k}>A link to page {k}</a></p>" for k in range(4))
    body = f"<h1>{head}</h1><p>{by}</p><p>{day}</p><p>{para}</p><p>Short.</p><p><a href=/s>The source of it all</a></p><p>End.</p>"
    want = [head, by, day, para.strip(), "Short.", "The source of it all", "End."]
    assert html_text.main_text(f"<body>{body}</body>").split("\n") == want
    assert html_text.main_text(f"<body>{links}{body}{links}</body>").split("\n") == want
    twice = html_text.main_text(f"<body>{links}{body}{links}{body}</body>").split("\n")
    assert twice == want + want


def test_html_odd_pages(spark):
    for page in ("", "<", "a < b", "<p>", "<!--", "<script>", "<a " * 3000, "<nav>" * 3000, "<div><p>x" * 3000, "</p>" * 50):
        html_text.main_text(page)
    assert html_text.main_text("plain text only") == "plain text only"
    df = spark.createDataFrame([(1, None, "u", 1), (2, "<p>x</p>", None, 2), (2, "<p>x</p>", None, 2)],
                               "page_id int, html string, url string, text int")
    assert sorted((r.page_id, r.text, r.n_chars) for r in html_text.extract(df).collect()) == [
        (1, "", 0), (2, "x", 1), (2, "x", 1)]
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def judged(spark):
    calm = "the river runs along green hills and quiet stones under a wide sky".split()
    rows = []
    for k in range(240):
        words = [rng.choice(calm) for _ in range(40)]
        if k % 4 == 0:
            words[rng.randrange(40)] = rng.choice(["zorb", "zorbel", "zorbin"])
            words[rng.randrange(40)] = "you"
        rows.append((k, " ".join(words), int(k % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()


def test_toxicity(odd, none, judged):
    model = toxicity.fit(judged, judged.select("doc_id", "toxic"), F.col("doc_id") < 160)
    got = model.transform(judged).where("doc_id >= 160").collect()
    assert sum(r.predicted == r.toxic for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    out = model.transform(odd)
    assert out.count() == len(TEXTS) and out.where("score is null").count() == 0
    assert model.transform(none).count() == 0
    blank = toxicity.fit(none, judged.select("doc_id", "toxic"), F.lit(True))
    assert blank.transform(odd).where("score between 0 and 1").count() == len(TEXTS)


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    now = docs
    for _, step in corpus_pipeline.STAGES[:-1]:
        now = step(spark, now, sf_dir)
        assert now.columns == docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    after = now.collect()
    copies = Counter(r.doc_id for r in after)
    assert set(copies) <= set(before) and max(copies.values()) <= 2
    assert len({r.text for r in after}) == len(copies)          # exact copies are gone
    assert not any(base_spans(r.text) for r in after)
    assert all(r.text == before[r.doc_id] for r in after if not base_spans(before[r.doc_id]))
    final = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).collect()
    library = Tokenizer.from_file(VOCABULARY)
    texts = {r.doc_id: r.text for r in after}
    assert len(final) == len(after)
    assert all(r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in final)


def test_pipeline_on_odd_rows(spark, odd, none, sf_dir):
    for start in (odd, none, odd.unionByName(odd)):
        now = start
        for _, step in corpus_pipeline.STAGES[1:]:
            now = step(spark, now, sf_dir)
        assert now.count() <= 2 * len(TEXTS)
    kept = corpus_pipeline.drop_near_copies(spark, odd.unionByName(odd), sf_dir)
    assert kept.count() == kept.select("text").distinct().count()


def test_near_copies_by_five_word_similarity(spark, sf_dir):
    words = [f"w{k}" for k in range(6000)]
    texts = {}
    for g in range(8):                        # each text and copies with spread changes; some are no near copies
        base = rng.sample(words, 150)
        for k in range(30):
            copy = list(base)
            for at in rng.sample(range(150), k % 10):
                copy[at] = rng.choice(words)
            texts[100 * g + k] = " ".join(copy)
    sets = {k: {tuple(w[i:i + 5]) for i in range(146)} for k, t in texts.items() for w in [t.split()]}
    least = {}
    for k in texts:
        if k not in least:
            reach, todo = {k}, [k]
            while todo:
                a = todo.pop()
                near = [b for b in texts if b not in reach and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
                reach |= set(near)
                todo += near
            least |= dict.fromkeys(reach, min(reach))
    assert 8 < len(set(least.values())) < len(texts)
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, sf_dir).collect()}
    assert kept == set(least.values())


def test_near_copies_take_candidates_by_simhash(spark):
    """With bands that nothing shares, sets within two bits of a fingerprint are still found."""
    words = [f"w{k}" for k in range(9000)]
    texts = {}
    for g in range(6):
        base = rng.sample(words, 1500)
        for k in range(8):
            copy = list(base)
            for at in rng.sample(range(1500), k):
                copy[at] = rng.choice(words)
            texts[100 * g + k] = " ".join(copy)
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    rules = near_copies.NearCopyRules(bands=1, rows=1000)
    hashed = near_copies._sets(df, "text", rules, F.col("doc_id")).collect()
    prints = {r.doc_id: simhash.vote(np.array(r._set, "<i8")) & (2 ** 64 - 1) for r in hashed}
    found = {r.doc_id: r.component_id for r in near_copies.near_copies(df, rules=rules).collect()}
    pairs = [(a, b) for a in texts for b in texts if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert len(pairs) > 6 and all(a // 100 == b // 100 and found[a] == found[b] for a, b in pairs)
