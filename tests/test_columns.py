"""Column expressions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from terrace.functions import columns as c
from terrace.functions.text import standardize_name


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).head()["x"]


@pytest.mark.parametrize("raw, want", [
    ("   três rios ", "Três Rios"),
    ("águas    da serra", "Águas da Serra"),
    ("EMBU-GUAÇU", "Embu-Guaçu"),
    ("dos ventos", "Dos Ventos"),
    ("\tlagoa\tda prata ", "Lagoa da Prata"),
    ("BEIRA-MAR SUL", "Beira-Mar Sul"),
    ("pau-de ferro", "Pau-de Ferro"),
    ("vila de", "Vila De"),
    ("de-lá para cá", "De-Lá Para Cá"),
    ("x e y E z", "X e Y e Z"),
    ("", ""),
])
def test_standardize_name(spark, raw, want):
    assert one(spark, standardize_name(F.lit(raw))) == want


def test_standardize_keeps_null(spark):
    assert one(spark, standardize_name(F.lit(None).cast("string"))) is None


def test_codes_and_keys(spark):
    assert one(spark, c.canonical_code(F.lit("  x1 "))) == "X1"
    assert one(spark, c.derive_key(F.lit(7700123), 100000, "int")) == 77
    assert one(spark, c.derive_key(F.lit(7700123), 10)) == 770012
    assert one(spark, c.default_to(F.lit(None).cast("int"), 0)) == 0


@pytest.mark.parametrize("value, want", [
    (19999, "S"), (20000, "M"), (99999, "M"), (100000, "L"), (None, None)])
def test_band_keeps_null(spark, value, want):
    col = F.lit(value).cast("long")
    assert one(spark, c.band(col, (20000, 100000), ("S", "M", "L"))) == want


def test_band_null_rules(spark):
    null = F.lit(None).cast("double")
    assert one(spark, c.band(null, (40,), ("LOW", "HIGH"), null_is_last=True)) == "HIGH"
    assert one(spark, c.band(null, (40,), ("LOW", "HIGH"), null_label="NONE")) == "NONE"
    with pytest.raises(ValueError):
        c.band(null, (40, 60), ("LOW", "HIGH"))


@pytest.mark.parametrize("actual, target, want", [
    (91.0, 50.0, "ABOVE"), (50.3, 50.0, "ON"), (12.0, 50.0, "BELOW"), (50.5, 50.0, "ABOVE"),
    (49.5, 50.0, "ON"), (49.4, 50.0, "BELOW"), (None, 50.0, "BELOW"), (70.0, None, "BELOW")])
def test_status(spark, actual, target, want):
    a, t = F.lit(actual).cast("double"), F.lit(target).cast("double")
    assert one(spark, c.target_status(a, t)) == want
    assert one(spark, c.gap_status(c.gap(a, t))) == want


def test_status_null_label(spark):
    null = F.lit(None).cast("double")
    assert one(spark, c.target_status(null, F.lit(65.0), null_label="NO DATA")) == "NO DATA"
    assert one(spark, c.gap_status(null, null_label="NO DATA")) == "NO DATA"


def test_numbers(spark):
    null = F.lit(None).cast("int")
    assert one(spark, c.pct(F.lit(1), F.lit(3))) == 33.3
    assert one(spark, c.pct(F.lit(3), F.lit(0))) is None
    assert one(spark, c.pct(F.lit(3), F.lit(2000))) == 0.2
    assert one(spark, c.capped(F.lit(9), F.lit(5))) == 5
    assert one(spark, c.capped(null, F.lit(5))) == 5
    assert one(spark, c.null_if_below(F.lit(-1.0))) is None
    assert one(spark, c.null_if_below(F.lit(0.0))) == 0.0
    assert one(spark, c.cutoff_flag(F.lit(12.0), 12)) == 1
    assert one(spark, c.cutoff_flag(F.lit(11.9), 12)) == 0
    assert one(spark, c.cutoff_flag(F.lit(None).cast("double"), 12)) is None
    assert one(spark, c.rounded(F.lit("61.25"))) == 61.3
    assert one(spark, c.prefer(F.lit(None).cast("double"), F.lit(4.5))) == 4.5


def test_labels(spark):
    assert one(spark, c.label_by(F.lit(2), {1: "a", 2: "b"}, "z")) == "b"
    assert one(spark, c.label_by(F.lit(9), {1: "a", 2: "b"}, "z")) == "z"
    null = F.lit(None).cast("double")
    assert one(spark, c.provenance((null, "P"), (F.lit(1.0), "Q"), otherwise="R")) == "Q"
    assert one(spark, c.provenance((null, "P"), otherwise="R")) == "R"


@pytest.mark.parametrize("text, want", [
    (" Natal", True), ("Natal ", True), ("NATAL", True), ("Natal", False), ("12", True)])
def test_looks_dirty(spark, text, want):
    assert one(spark, c.looks_dirty(F.lit(text))) is want


def test_pseudonym(spark):
    want = hashlib.sha256(b"7700123-2019-4").hexdigest()[:16]
    assert one(spark, c.pseudonym(F.lit(7700123), F.lit(2019), F.lit(4))) == want


def test_leakage_guard(spark):
    df = spark.createDataFrame([(1, 2, 3.0)], "entity_id int, assessed int, label double")
    with pytest.raises(c.LeakageError, match="leakage.*assessed"):
        c.refuse_columns(df, ["assessed", "gap"])
    assert c.refuse_columns(df, ["gap"]) is df


def test_rounding_does_not_depend_on_partitioning(spark):
    df = spark.range(5000).select((F.col("id") * 0.01 + 0.1).alias("x"))
    seen = {df.repartition(n).agg(c.mean_at(F.col("x"), 3)).head()[0] for n in (1, 3, 7)}
    assert len(seen) == 1


def test_ties_are_rounded_away_from_zero(spark):
    values = {0.7845: 0.785, -0.7845: -0.785, 0.78449: 0.784, 2.0: 2.0, 1e17: 1e17}
    for x, want in values.items():
        assert one(spark, c.round_at(F.lit(x), 3)) == want
