"""Personal data by bootstrapped contextual extraction.

Base expressions find e-mail addresses, network addresses, card and phone
numbers. They seed a graph between instances (texts of entities and of other
identifier-like runs: groups of digits, however they are set apart, tokens with
digits in them, addresses without a domain's dot or spelled with "at" and "dot")
and lexical patterns (two words before; the words on both sides). Confidence
moves along the graph for a few rounds: a pattern's is the share of its distinct
instances that are known or believed to be of a kind, where an instance of no
known kind is half a counterexample; an instance's grows with its confident
patterns. Unseen identifiers in places of confident patterns are added to the
spans. Copies of a text do not raise a confidence, as instances count once.

A text is walked in pieces of about a thousand characters, cut where neither a
base entity nor a candidate can reach over, so that places and contexts are
looked up within a piece. (A run of digits, brackets and blanks without any
other character has no such place and is one piece.)

DataFrame functions only. A text is read once; what is shuffled are mentions,
which few texts have, their patterns and their instances, combined before. The
graph's tables are written each round.

Offsets are code points. Null and empty texts have no spans. Rows that repeat
an id are told apart by their text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import row_hash, text_of
from terrace.sources.staging import stage

KINDS = ("email", "ip", "card", "phone")

# The base expressions; possessive where nothing can be given back, and tried
# only where a run of their characters begins (or the last match ended).
EXPRESSIONS = {
    "email": "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++(?:\\.[0-9]++)(?:\\.[0-9]++)(?:\\.[0-9]++)",
    "card": "[0-9](?:[\\x20-]?+[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
_OCTET = "^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"
# other identifier-like runs: addresses, also spelled; groups of digits, three or more in all; tokens with five digits
_AT = "\\x20?[(\\[{]\\x20?(?:at|@)\\x20?[)\\]}]\\x20?"
_DOT = "\\x20?[(\\[{]\\x20?(?:dot|\\.)\\x20?[)\\]}]\\x20?"
_NAME = "[\\p{L}\\p{N}_-]++"
_OTHER = "|".join([
    "(?i)(?<![\\p{L}\\p{N}._%+-])[\\p{L}\\p{N}._%+-]++"
    f"(?:(?:{_AT}|@){_NAME}(?:(?:{_DOT}|\\x20dot\\x20|\\.){_NAME})*+|\\x20at\\x20{_NAME}(?:\\x20dot\\x20{_NAME})++)",
    "(?<![\\p{L}\\p{N}@._%+-])(?=[(+]?(?:[\\x20().\\-/]{0,2}[0-9]){3})[(+]?[0-9]++"
    "(?:(?:\\)[\\x20-]?|[\\x20.\\-/]\\(?)[0-9]++)*+(?=[^\\p{L}\\p{N}\\s]*+(?:\\s|$))",
    "(?<!\\S)(?=(?:[^\\s0-9]*+[0-9]){5})\\S++"])
_MAY_HOLD = "(?i)[0-9@]|[(\\[{]\\x20?at|\\x20dot\\x20"
# before a blank over which no expression reaches: no digit, bracket, dot or dash before it, no "at" or "dot" beside it
_CUT = ("(?:(?=[\\n\\r\\t])|(?<=[^0-9()\\[\\]{}.\\x20/+-])(?<!\\b(?:at|dot))"
        "(?=\\x20(?!\\x20*(?:[()\\[\\]{}@]|(?:at|dot)\\b))))")
_PIECE = f"(?is).{{1024}}.*?{_CUT}|.+"
_GROUP = 128    # lengths that are added up at a time
_NEAR = 80      # characters of context that are looked at
_SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


@dataclass(frozen=True)
class BootstrapRules:
    rounds: int = 3
    min_instances: float = 4.0     # of a kind behind a confident pattern
    confident: float = 0.7
    doubt: float = 0.5             # weight of an instance of no known kind against a pattern


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is made once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), 0)


def _starts(lengths: Column) -> Column:
    """For every length the sum of those before it; added up in groups, as a list that grows is copied each time."""
    def walk(part: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, start, lambda acc, n: F.struct(
            (acc["at"] + n).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")))

    def joined(groups: Column) -> Column:
        firsts = walk(F.transform(groups, lambda g: g["at"]))["out"]
        return F.flatten(F.zip_with(groups, firsts, lambda g, first: F.transform(g["out"], lambda at: at + first)))

    return _let(lengths, lambda all_: F.when(F.size(all_) <= _GROUP, walk(all_)["out"]).otherwise(_let(
        F.transform(F.sequence(F.lit(1), F.size(all_), F.lit(_GROUP)), lambda k: walk(F.slice(all_, k, F.lit(_GROUP)))),
        joined)))


def pieces(text: Column) -> Column:
    """The text cut where no entity is cut: (at, text, before, after), with the characters beside each piece."""
    def placed(parts: Column) -> Column:
        starts = _starts(F.transform(parts, F.length))
        return F.transform(F.arrays_zip(parts.alias("text"), starts.alias("at")), lambda p, k: F.struct(
            p["at"].alias("at"), p["text"].alias("text"),
            F.coalesce(F.substring(F.get(parts, k - 1), -_NEAR, _NEAR), F.lit("")).alias("before"),
            F.coalesce(F.substring(F.get(parts, k + 1), 1, _NEAR), F.lit("")).alias("after")))

    return _let(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), placed)


def _places(text: Column, expression: str) -> Column:
    """(start, end, text) of every match."""
    kind = "array<struct<start:int,end:int,text:string>>"
    # between[k] stands before match k
    steps = F.arrays_zip(F.split(text, expression, -1).alias("between"),
                         F.regexp_extract_all(text, F.lit(expression), F.lit(0)).alias("match"))

    def placed(steps: Column) -> Column:
        ends = _starts(F.transform(steps, lambda s: F.length(s["between"]) + F.coalesce(F.length(s["match"]), F.lit(0))))
        found = F.filter(F.arrays_zip(steps.alias("step"), ends.alias("at")), lambda p: p["step"]["match"].isNotNull())
        return F.transform(found, lambda p: F.struct(
            (p["at"] + F.length(p["step"]["between"])).alias("start"),
            (p["at"] + F.length(p["step"]["between"]) + F.length(p["step"]["match"])).alias("end"),
            p["step"]["match"].alias("text")))

    return F.when(text.rlike(expression), _let(steps, placed).cast(kind)).otherwise(F.array().cast(kind))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.reverse(F.split(digits, "")).cast("array<int>")
    doubled = F.transform(each, lambda d, k: F.when(k % 2 == 0, d).otherwise(
        2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _holds(kind: str, text: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(text, "\\."), lambda p: p.rlike(_OCTET))
    n = F.length(_digits(text))
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(_digits(text))).otherwise(False)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _base(text: Column) -> Column:
    """Base entities of a piece by start, then kind."""
    def of(rank: int, kind: str) -> Column:
        held = F.filter(_places(text, EXPRESSIONS[kind]), lambda m: _holds(kind, m["text"]))
        return F.transform(held, lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")))

    found = [of(rank, kind) for rank, kind in enumerate(KINDS)]
    every = F.array_sort(F.concat(*found)).cast(_SPAN)
    return F.when(text.rlike("[0-9@]"), every).otherwise(F.array().cast(_SPAN))


def _moved(spans: Column, by: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(
        (s["start"] + by).alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), (s["end"] + by).alias("end")))


def _others(text: Column, known: Column) -> Column:
    """Spans of a piece's other identifier-like runs, without the marks around them, that touch no known span."""
    lead = "^(?!\\([0-9]+\\)|\\+[0-9])[^\\p{L}\\p{N}]*+"
    cores = F.transform(_places(text, _OTHER), lambda m: F.struct(
        (m["start"] + F.length(F.regexp_extract(m["text"], lead, 0))).alias("start"),
        F.lit(len(KINDS)).alias("rank"), F.lit(None).cast("string").alias("kind"),
        (m["end"] - F.length(F.regexp_extract(m["text"], "(?<=[\\p{L}\\p{N}])[^\\p{L}\\p{N}]*+$", 0))).alias("end")))
    apart = F.filter(cores, lambda c: (c["end"] > c["start"]) & ~F.exists(
        known, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])))
    return F.when(text.rlike(_MAY_HOLD), apart.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " ")), " ")


def _mention(piece: Column, span: Column) -> Column:
    text = piece["text"]
    left = _words(F.substring(F.concat(piece["before"], F.substring(text, F.lit(1), span["start"])), -_NEAR, _NEAR))
    right = _words(F.substring(F.concat(F.substring(text, span["end"] + 1, F.lit(_NEAR)), piece["after"]), 1, _NEAR))
    instance = F.substring(text, span["start"] + 1, span["end"] - span["start"])
    one, two, after = F.try_element_at(left, F.lit(-1)), F.try_element_at(left, F.lit(-2)), F.get(right, 0)
    return F.struct(
        (span["start"] + piece["at"]).alias("start"), (span["end"] + piece["at"]).alias("end"),
        span["kind"].alias("kind"), instance.alias("instance"),
        F.array_compact(F.array(
            F.when((one != "") & (two != ""), F.concat_ws(" ", two, one, F.lit("_"))),
            F.when((one != "") & (after != ""), F.concat_ws(" ", one, F.lit("_"), after)))).alias("patterns"))


def _read(piece: Column) -> Column:
    """(base, mentions) of a piece, in places of the whole text."""
    def both(base: Column) -> Column:
        # an entity inside the one before, such as a phone number's digits, is no mention of its own
        outer = F.filter(base, lambda s, k: ~F.coalesce(F.get(base, k - 1)["end"] >= s["end"], F.lit(False)))
        every = F.concat(outer, _others(piece["text"], base))
        return F.struct(_moved(base, piece["at"]).cast(_SPAN).alias("base"),
                        F.transform(every, lambda s: _mention(piece, s)).alias("mentions"))

    return _let(_base(piece["text"]), both)


def read_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(_key, _row, base, mentions) of every row, stored: the only pass over the texts."""
    rows = df.select(F.col(key).alias("_key"), text_of(text).alias("_text"))
    read = F.filter(F.transform(pieces(F.col("_text")), _read), lambda r: F.size(r["mentions"]) > 0)
    rows = rows.select("_key", row_hash(F.col("_text")).alias("_row"), read.alias("_read"))
    return stage(rows.select("_key", "_row", F.flatten("_read.base").cast(_SPAN).alias("base"),
                             F.flatten("_read.mentions").alias("mentions")), "mentions")


def confident_patterns(mentions: DataFrame, rules: BootstrapRules = BootstrapRules()) -> DataFrame:
    """(pattern, kind, confidence) of the patterns worth trusting, from exploded mentions."""
    edges = stage(mentions.select(F.explode("patterns").alias("pattern"), "instance").distinct(), "edges")
    seeds = mentions.where("kind is not null").groupBy("instance").agg(F.min("kind").alias("kind"))
    known = stage(seeds.withColumn("score", F.lit(1.0)), "known")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    believed, patterns = known, None
    for _ in range(rules.rounds):
        held = edges.join(believed, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("held"))
        held = held.where(F.col("held") >= rules.min_instances).join(sizes, "pattern")
        share = F.col("held") / (F.col("held") + rules.doubt * (F.col("n") - F.col("held")) + 1)
        patterns = stage(held.select("pattern", "kind", share.alias("confidence")), "patterns")
        # an instance not known yet is believed by one minus the product of its patterns' doubts
        doubt = F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(0.999))))
        raised = edges.join(patterns.where(F.col("confidence") >= rules.confident), "pattern").groupBy(
            "instance", "kind").agg((1 - F.exp(doubt)).alias("score"))
        raised = raised.join(known.select("instance"), "instance", "left_anti")
        best = raised.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("_b"))
        believed = stage(known.unionByName(best.select(
            "instance", F.col("_b.kind").alias("kind"), F.col("_b.score").alias("score"))), "believed")
    return patterns.where(F.col("confidence") >= rules.confident)


def discovered(rows: DataFrame, rules: BootstrapRules = BootstrapRules()) -> DataFrame:
    """(_key, _row, more): spans beyond the base, for the rows that have some; stored."""
    mentions = rows.select("_key", "_row", F.explode("mentions").alias("_m")).select("_key", "_row", "_m.*")
    trusted = confident_patterns(mentions, rules)
    places = mentions.where("kind is null").select(
        "_key", "_row", "start", "end", F.explode("patterns").alias("pattern"))
    ranks = F.create_map(*[F.lit(x) for rank, kind in enumerate(KINDS) for x in (kind, rank)])
    hits = places.join(trusted, "pattern").groupBy("_key", "_row", "start", "end").agg(
        F.max(F.struct("confidence", "kind")).alias("_b"))
    return stage(hits.groupBy("_key", "_row").agg(F.sort_array(F.collect_set(F.struct(
        "start", F.get(F.array(*[F.lit(r) for r in range(len(KINDS))]), ranks[F.col("_b.kind")]).alias("rank"),
        F.col("_b.kind").alias("kind"), "end"))).cast(_SPAN).alias("more")), "discovered")


def find(df: DataFrame, key: str = "doc_id", text: str = "text",
         rules: BootstrapRules = BootstrapRules()) -> DataFrame:
    """(key, row_hash, base, spans) of every row; spans are (start, rank, kind, end)."""
    rows = read_texts(df, key, text)
    r, d = rows.alias("r"), discovered(rows, rules).alias("d")
    return r.join(d, F.col("r._key").eqNullSafe(F.col("d._key")) & (F.col("r._row") == F.col("d._row")), "left").select(
        F.col("r._key").alias(key), F.col("r._row").alias("row_hash"), "base",
        F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(_SPAN)))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def mask(df: DataFrame, key: str = "doc_id", text: str = "text",
         rules: BootstrapRules = BootstrapRules()) -> DataFrame:
    """``df`` with every span of its text replaced by the kind in brackets; all columns are kept."""
    more = discovered(read_texts(df, key, text), rules).select(
        F.col("_key").alias("_k"), F.col("_row").alias("_r"), F.col("more").alias("_more"))
    t = F.col("_text")
    rows = df.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias("_all"),
                     F.col(key).alias("_key"), F.col(text).alias("_text"))
    rows = rows.withColumn("_h", row_hash(text_of("_text")))
    rows = rows.join(more, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_h") == F.col("_r")), "left")
    parts = F.transform(pieces(text_of("_text")), lambda p: _masked(p, F.col("_more")))
    masked = F.when(F.col("_text").isNotNull(), F.array_join(parts, ""))
    return rows.select(F.col("_all").withField(text, masked).alias("_all")).select("_all.*")


def _masked(piece: Column, more: Column) -> Column:
    """The piece with its own spans and those of ``more`` that begin in it replaced."""
    t, at = piece["text"], piece["at"]
    inside = F.filter(more, lambda s: (s["start"] >= at) & (s["start"] < at + F.length(t)))
    added = F.coalesce(_moved(inside, -at).cast(_SPAN), F.array().cast(_SPAN))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        # a span that begins inside the one before only moves the end on
        gap = F.substring(t, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] < acc["at"], acc["out"]).otherwise(
            F.concat(acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).alias("out"))

    def walked(spans: Column) -> Column:
        return F.when(F.size(spans) == 0, t).otherwise(F.aggregate(spans, start, add, lambda acc: F.concat(
            acc["out"], F.substring(t, acc["at"] + 1, F.greatest(F.length(t) - acc["at"], F.lit(0))))))

    return _let(F.array_sort(F.concat(_base(t), added)), walked)
