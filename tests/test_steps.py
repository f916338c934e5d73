"""Steps as a graph: order, versions, slices, killed and resumed runs."""

import pytest
from cadastra.operators.steps import Step, plan_steps, read_manifest, run_steps
from cadastra.plans.build import STEPS


def _names(planned):
    return [p.step.name for p in planned]


RAW = ["land_value_row", "ps_row_a", "ps_row_a_legacy", "ps_row_b", "ps_row_b_legacy", "ps_row_c", "ps_row_d"]


def test_what_a_table_needs():
    given = dict.fromkeys(RAW, "1")
    assert _names(plan_steps(STEPS, given, ["land_valuation"])) == ["land_valuation"]
    assert _names(plan_steps(STEPS, given, ["property_folio"])) == [
        "ranked_sales", "sale_descriptions", "legal_description", "parcels",
    ]
    # Without layer tables their step is left out; with them it extends two tables.
    assert "layers" not in _names(plan_steps(STEPS, given))
    layers = given | {"lot_feature_layer": "1", "property_feature_layer": "1"}
    assert {"parcels", "property", "layers"} <= set(_names(plan_steps(STEPS, layers, ["property"])))
    with pytest.raises(KeyError):
        plan_steps(STEPS, given, ["nothing"])
    with pytest.raises(KeyError):
        plan_steps(STEPS, {"land_value_row": "1"})


def test_versions_follow_what_is_read():
    given = dict.fromkeys(RAW, "1")
    old = {p.step.name: p.version for p in plan_steps(STEPS, given)}
    new = {p.step.name: p.version for p in plan_steps(STEPS, given | {"ps_row_d": "2"})}
    assert {n for n in old if old[n] != new[n]} == {"sources", "notice_of_sale"}


def test_killed_and_resumed(spark, tmp_path):
    ran, fail = [], {"c"}

    def step(name, reads, write, fn, **more):
        def run(t):
            ran.append(name)
            if name in fail:
                raise RuntimeError("killed")
            return {write: fn(*[t[r] for r in reads])}

        return Step(1, name, tuple(reads), (write,), run, **more)

    steps = [
        step("a", ["raw"], "x", lambda d: d.selectExpr("id * 2 AS id")),
        step("b", ["other"], "y", lambda d: d.selectExpr("id + 1 AS id")),
        step("c", ["x", "y"], "z", lambda x, y: x.join(y, "id")),
        # Extends a table that the step before still reads.
        step("d", ["x", "z"], "x", lambda x, z: x.unionByName(z)),
    ]
    raw = {"raw": spark.range(6), "other": spark.range(6)}
    out = str(tmp_path / "out")
    with pytest.raises(RuntimeError):
        run_steps(steps, raw, out, {"raw": "1"})
    assert ran == ["a", "b", "c"] and read_manifest(spark, out).count() == 2
    ran.clear(), fail.clear()
    made = run_steps(steps, raw, out, {"raw": "1"})
    assert ran == ["c", "d"]
    assert sorted(r.id for r in made["z"].collect()) == [2, 4, 6]
    assert sorted(r.id for r in made["x"].collect()) == [0, 2, 2, 4, 4, 6, 6, 8, 10]
    ran.clear()
    again = run_steps(steps, raw, out, {"raw": "1"})
    assert ran == [] and again["x"].count() == 9
    # A new state of one raw table: only what lies below it; then one step by name.
    run_steps(steps, raw, out, {"raw": "2"})
    assert ran == ["a", "c", "d"]
    ran.clear()
    run_steps(steps, raw, out, {"raw": "2"}, wanted=["y"], again=["b"])
    assert ran == ["b"]
    # The manifest says what each result was made of.
    row = read_manifest(spark, out).filter("step = 'c'").orderBy("written").first()
    assert set(row.reads) == {"x", "y"} and row.tables["z"].endswith("/z")
    with pytest.raises(ValueError):
        run_steps([Step(1, "e", ("raw",), ("v",), lambda t: {})], raw, out)
