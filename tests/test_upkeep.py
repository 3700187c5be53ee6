"""The insured table kept up by changes against the insured table built anew."""

import random

import pytest
from rows import bag, planned

from partyfold import fixed, plans
from partyfold import sources as io

POLICIES = "num_poliza string, num_version int, cve_filiacion string, other int"
MASTER = ", ".join(f"{c} string" for c in [fixed.MASTER_KEY, *fixed.MASTER_COLUMNS]) + ", other int"
CONTACTS = ", ".join(f"{c} string" for c in [fixed.CONTACT_KEY, *fixed.CONTACT_COLUMNS]) + ", other int"
PARTIES = ["K1", "K2", "K3", "K3 ", " ", "", None, "unknown"]


def some(rng, n):
    """Rows of the three tables, with repeats, blanks and nulls."""
    word = lambda: rng.choice([None, "", "x", "#", "F"])
    policies = [(rng.choice("PQRS"), rng.choice([1, 2, None]), rng.choice(PARTIES), 0) for _ in range(n)]
    master = [(rng.choice(PARTIES), *[word() for _ in fixed.MASTER_COLUMNS], 0) for _ in range(n // 2)]
    contacts = [(rng.choice(PARTIES), *[word() for _ in fixed.CONTACT_COLUMNS], 0) for _ in range(n // 2)]
    return [policies, master, contacts]


def changed(rng, tables):
    """Some rows go, some change in one column, some come."""
    fresh, result = some(rng, 8), []
    for rows, more in zip(tables, fresh):
        rows = [r for r in rows if rng.random() > 0.2]
        for _ in range(min(3, len(rows))):
            i, j = rng.randrange(len(rows)), rng.randrange(len(rows[0]))
            rows[i] = (*rows[i][:j], rng.choice(more)[j] if more else None, *rows[i][j + 1 :])
        result.append(rows + more[: rng.randrange(4)])
    return result


def inputs(frame, tables):
    return plans.InsuredInputs(*[frame(rows, schema) for rows, schema in zip(tables, (POLICIES, MASTER, CONTACTS))])


def built(given, spread=False):
    return plans.insured_flat(given.policies, given.master, given.contacts, spread)


@pytest.mark.parametrize("seed", range(5))
@pytest.mark.parametrize("spread", [False, True])
def test_kept_up_equals_built_anew(spark, frame, tmp_path, seed, spread):
    rng = random.Random(seed)
    path, now = str(tmp_path / "insured"), some(rng, 30)
    io.overwrite_dataset(built(inputs(frame, now)), path)
    for _ in range(2):
        later = changed(rng, now)
        found = plans.refresh_insured(path, inputs(frame, now), inputs(frame, later), spread=spread)
        assert bag(found) == bag(built(inputs(frame, later)))
        now = later


def test_the_next_smallest_row_comes_up_after_a_deletion(spark, frame, tmp_path):
    master = [("A", *["1"] * 6, 0), ("A", *["2"] * 6, 0), ("B", *["3"] * 6, 0)]
    policies = [("P", 1, "A", 0), ("P", 1, "B", 0)]
    path = str(tmp_path / "insured")
    steps = [
        ([policies, master, []], ("A", "1")),
        ([policies, master[1:], []], ("A", "2")),
        ([policies[1:], master[1:], []], ("B", "3")),
        ([policies[1:], [], []], ("B", None)),
        ([[], [], []], None),
        ([policies, master, []], ("A", "1")),
    ]
    io.overwrite_dataset(built(inputs(frame, steps[0][0])), path)
    for (old, _), (new, expected) in zip(steps, steps[1:]):
        rows = plans.refresh_insured(path, inputs(frame, old), inputs(frame, new)).collect()
        assert [(r["cve_asegurado"], r["rfc"]) for r in rows] == ([expected] if expected else [])


def test_only_versions_that_can_change_are_affected(frame):
    from partyfold.plans import upkeep

    tables = some(random.Random(1), 5)
    tables[0] = [("P", 1, "K1", 0), ("P", 2, "K2", 0), ("Q", 1, "K1", 0), ("R", 1, "K3", 0)]
    tables[1] = [(k, *["x"] * 6, 0) for k in ("K1", "K2", "K3", "nobody")]
    tables[2] = []
    later = [
        [*tables[0][:3], ("R", 1, "K3", 9)],  # a column that the insured table does not use
        [*tables[1][:1], ("K2", *["y"] * 6, 0), *tables[1][2:3], ("nobody", *["y"] * 6, 0)],
        [],
    ]
    old, new = inputs(frame, tables), inputs(frame, later)
    versions, parties = upkeep.changed_versions(old, new), upkeep.changed_parties(old, new)
    assert bag(versions) == {}
    assert bag(parties) == {("K2",): 1, ("nobody",): 1}
    assert bag(plans.affected_versions(built(old), versions, parties)) == {("P", 2): 1}


def test_inputs_are_cut_to_what_is_needed_before_anything_is_joined(spark, frame, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    given = inputs(frame, some(random.Random(1), 10))
    affected = frame([("P", 1)], "num_poliza string, num_version int")
    plan = planned(plans.insured_upkeep(built(given), given, affected, spread=False))
    rebuilt = plan[plan.index("Union") :]
    assert rebuilt.count("LeftSemi") >= 3 and plan.count("LeftAnti") == 1
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    outer = plan.index("LeftOuter", plan.index("LeftAnti"))
    assert "LeftSemi" in plan[outer:]


def test_changed_versions_come_with_the_smallest_party_they_have_now(frame):
    from partyfold.plans import upkeep

    old = inputs(frame, [[("P", 1, "A", 0), ("P", 1, "B", 0), ("Q", None, "C", 0), ("R", 1, "D", 0), ("S", 1, " ", 0)], [], []])
    later = [("P", 1, "B", 0), ("P", 1, "C", 0), ("Q", None, " ", 0), ("R", 1, "D", 9), ("S", 1, "Z", 0)]
    found = upkeep.changed_versions(old, inputs(frame, [later, [], []]))
    assert bag(found) == {("P", 1, "B"): 1, ("Q", None, None): 1, ("S", 1, "Z"): 1}


def test_policies_are_read_for_the_comparison_only(spark, frame, tmp_path, monkeypatch):
    from partyfold.plans import upkeep

    def stored(name, tables):
        for part, df in zip(("policies", "master", "contacts"), vars(inputs(frame, tables)).values()):
            df.write.parquet(str(tmp_path / name / part))
        return plans.InsuredInputs(*[spark.read.parquet(str(tmp_path / name / p)) for p in ("policies", "master", "contacts")])

    rng = random.Random(3)
    now = some(rng, 30)
    old, new = stored("old", now), stored("new", changed(rng, now))
    path, kept_plans, write = str(tmp_path / "insured"), [], upkeep.overwrite_dataset
    io.overwrite_dataset(built(old), path)
    monkeypatch.setattr(upkeep, "overwrite_dataset", lambda df, *a: (kept_plans.append(set(df.inputFiles())), write(df, *a)))
    assert bag(plans.refresh_insured(path, old, new)) == bag(built(new))
    [read] = kept_plans
    assert any("/new/master/" in f for f in read) and not any("/policies/" in f and str(tmp_path / "new") in f for f in read)
