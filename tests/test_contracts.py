"""Contracts against brute force over generated rows with planted violations (Q01-Q20)."""

import random
import re

import pytest

from terrace.operators.contracts import (
    Contract, ContractViolation, apply_contract, contract_summary, enforce, load_contracts, summarize)

N = 400
KNOWN = range(0, 60)
CHECKS = {
    "code_there": ({"rule": "not_null", "column": "code"}, lambda r: r["code"] is not None and r["code"].strip() != ""),
    "size_inside": ({"rule": "range", "column": "size", "value": [1, 7]}, lambda r: r["size"] is None or 1 <= r["size"] <= 7),
    "size_known": ({"rule": "range", "column": "size", "value": [1, 7], "allow_null": False},
                   lambda r: r["size"] is not None and 1 <= r["size"] <= 7),
    "kind_listed": ({"rule": "allowed", "column": "kind", "value": ["box", "can"]}, lambda r: r["kind"] in (None, "box", "can")),
    "code_shape": ({"rule": "regex", "column": "code", "value": "[A-Z][0-9]"},
                   lambda r: r["code"] is None or bool(re.search("[A-Z][0-9]", r["code"]))),
    "shelf_known": ({"rule": "foreign_key", "column": "shelf", "reference": "shelves", "reference_column": "no"},
                    lambda r: r["shelf"] in KNOWN),
}


def plant(seed):
    draw = random.Random(seed)
    return [dict(no=k, code=draw.choice(["A1", "B22", "c3", " ", "", None, "xD4y"]), size=draw.choice([None, 0, 1, 4, 7, 8]),
                 kind=draw.choice(["box", "can", "jar", None]), shelf=draw.choice([3, 59, 60, 1000, None]))
            for k in range(N)]


@pytest.fixture(scope="module")
def rows():
    return plant(11)


@pytest.fixture(scope="module")
def goods(spark, rows):
    return spark.createDataFrame(
        [tuple(r.values()) for r in rows], "no int, code string, size int, kind string, shelf int")


@pytest.fixture(scope="module")
def shelves(spark):
    return {"shelves": spark.createDataFrame([(k,) for k in KNOWN], "no int")}


def outcome(goods, shelves, names, **options):
    checks = [CHECKS[n][0] | options for n in names]
    out = apply_contract(goods, Contract.of(*checks), shelves)
    return out, sorted(out.report.collect(), key=lambda r: r["position"])


@pytest.mark.parametrize("names", [*[[n] for n in CHECKS], list(CHECKS), list(reversed(CHECKS))])
def test_split_reasons_and_counts(goods, shelves, rows, names):
    out, report = outcome(goods, shelves, names)
    broken = {r["no"]: [n for n in names if not CHECKS[n][1](r)] for r in rows}
    assert {r.no for r in out.valid.collect()} == {k for k, bad in broken.items() if not bad}
    named = {r.no: r._quarantine_reason for r in out.quarantine.collect()}
    label = {n: f"{CHECKS[n][0]['rule']}:{CHECKS[n][0]['column']}" for n in names}
    assert named == {k: "|".join(label[n] for n in bad) for k, bad in broken.items() if bad}
    assert out.valid.columns == goods.columns and set(out.quarantine.columns) == {*goods.columns, "_quarantine_reason"}
    for line, n in zip(report, names, strict=True):
        count = sum(n in bad for bad in broken.values())
        assert (line.violations, line.rows, line.passed) == (count, N, count == 0)
    assert contract_summary(out.report).first().asDict() == summarize(report)


@pytest.mark.parametrize("name", list(CHECKS))
def test_tolerance_decides_the_status_but_not_the_split(goods, shelves, rows, name):
    share = 100 * sum(not CHECKS[name][1](r) for r in rows) / N
    for tolerance, status in ((share, "PASS"), (share - 100 / N, "FAIL")):
        out, report = outcome(goods, shelves, [name], tolerance_pct=tolerance)
        assert report[0].status == status and out.quarantine.count() == report[0].violations > 0


def test_warnings_do_not_quarantine(goods, shelves):
    out, report = outcome(goods, shelves, list(CHECKS), critical=False)
    assert {r.status for r in report} == {"WARN"} and out.valid.count() == N and out.quarantine.isEmpty()
    enforce(report, "goods")


def test_table_checks(goods, rows):
    checks = [{"rule": "unique", "columns": ["code", "kind"]}, {"rule": "unique", "columns": ["no"]},
              {"rule": "min_count", "value": N}, {"rule": "min_count", "value": N + 3}]
    out = apply_contract(goods, Contract.of(*checks))
    report = sorted(out.report.collect(), key=lambda r: r["position"])
    repeats = N - len({(r["code"], r["kind"]) for r in rows})
    assert [(r.violations, r.status) for r in report] == [(repeats, "FAIL"), (0, "PASS"), (0, "PASS"), (3, "FAIL")]
    assert out.quarantine.isEmpty() and summarize(report)["score"] == 50.0
    with pytest.raises(ContractViolation, match="unique:code,kind"):
        enforce(out.report, "goods")
    with pytest.raises(ContractViolation, match="goods"):
        enforce(report, "goods")


def test_checks_that_cannot_be_made_are_reported_and_not_scored(goods):
    out = apply_contract(goods, Contract.of(
        {"rule": "not_null", "column": "gone"}, CHECKS["shelf_known"][0], {"rule": "unique", "columns": ["no", "gone"]}))
    report = out.report.collect()
    assert {r.status for r in report} == {"SKIPPED"} and len(out.skipped) == 3
    assert summarize(report)["score"] == 100.0 and out.valid.count() == N


def test_a_contract_without_checks_lets_all_pass(goods):
    out = apply_contract(goods, Contract())
    assert out.valid.count() == N and out.quarantine.isEmpty()
    assert contract_summary(out.report).first().asDict() == summarize(out.report.collect()) | {"rows_in": N}


def test_row_checks_share_one_scan(goods, shelves):
    checks = [CHECKS[n][0] for n in CHECKS if n != "shelf_known"] * 3
    plan = apply_contract(goods, Contract.of(*checks)).report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_shipped_contracts():
    from terrace.plans.retail_layers import CONTRACTS, LAYERS

    loaded = {s: load_contracts(CONTRACTS / f"{s}.yml") for s in LAYERS}
    assert all(c.checks and c.description for tables in loaded.values() for c in tables.values())
    assert {"region", "lineitem"} <= set(loaded["bronze"]) and "entity_view" in loaded["gold"]
