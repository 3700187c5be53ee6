"""The insured table on small inputs, against a plain Python account of the joins."""

import random
from itertools import product

import pytest
from rows import bag

from partyfold import fixed, plans
from partyfold import sources as io
from partyfold.__main__ import main
from partyfold.plans.insured import smallest_party_rows
from partyfold.session import session

POLICIES = "num_poliza string, num_version int, cve_filiacion string, other int"
MASTER = (
    "cdfiliac string, cdrfc string, tcpefiju string, dnnomrzm string, dnap1rzm string, "
    "dnap2rzm string, tscdc string, other int"
)
CONTACTS = ", ".join(f"{c} string" for c in [fixed.CONTACT_KEY, *fixed.CONTACT_COLUMNS])


def contact(key, **values):
    return (key, *[values.get(c) for c in fixed.CONTACT_COLUMNS])


@pytest.fixture
def build(frame):
    def make(policies, master=(), contacts=()):
        return plans.insured_flat(
            frame([(*p, 0) for p in policies], POLICIES),
            frame([(*m, 0) for m in master], MASTER),
            frame(list(contacts), CONTACTS),
        )

    return make


def only(df):
    [row] = df.collect()
    return row


def test_columns(build):
    result = build([])
    assert result.columns == fixed.INSURED_COLUMNS
    assert len(result.columns) == 34


def test_one_full_row(build):
    row = only(
        build(
            [("P1", 1, "K1")],
            [("K1", "RFC1", "F", "\tMU#OZ ", "Paz", None, "T")],
            [contact("K1", calle="Mayor", numero_extension_telefono_2="7")],
        )
    )
    expected = dict.fromkeys(fixed.INSURED_COLUMNS) | {
        "num_poliza": "P1",
        "num_version": 1,
        "cve_asegurado": "K1",
        "rfc": "RFC1",
        "tipo_participante": "F",
        "desc_tipo_persona": "Fisica",
        "nombre": "MUÑOZ",
        "primer_apellido": "Paz",
        "nombre_completo": "MUÑOZ Paz",
        "ind_rol": "ASEGURADO",
        "calle": "Mayor",
        "numero_extension_telefono_2": "7",
        "tscdc": "T",
    }
    assert row.asDict() == expected


def test_unusable_keys_are_dropped_and_a_tab_is_a_key(build):
    keys = [None, "", "  ", "\t", "K"]
    result = build([("P", n, key) for n, key in enumerate(keys)])
    assert {r.cve_asegurado for r in result.collect()} == {"\t", "K"}


def test_unmatched_party(build):
    row = only(build([("P", 1, "K1 ")], [("K1", "R", "F", "Ana", "Paz", "Gil", "T")]))
    assert row.cve_asegurado == "K1 "
    assert row.rfc is None and row.nombre is None and row.tscdc is None
    assert row.desc_tipo_persona == "Moral"
    assert row.nombre_completo == ""
    assert row.ind_rol == "ASEGURADO"


def test_contact_without_master_and_master_without_contact(build):
    master = [("A", "RA", "F", "Ana", "Paz", "Gil", "T")]
    result = build([("P", 1, "A"), ("P", 2, "B")], master, [contact("B", calle="c")])
    found = {r.num_version: (r.rfc, r.calle) for r in result.collect()}
    assert found == {1: ("RA", None), 2: (None, "c")}


def test_duplicates_leave_one_row_and_never_multiply(build):
    master = [("K", "R2", "M", "b", None, None, "T"), ("K", "R1", "F", "a", None, None, "T")]
    contacts = [contact("K", calle=c, numero=n) for c, n in (("z", "1"), (None, "3"), (None, "2"))]
    row = only(build([("P", 1, "K")] * 3, master, contacts))
    assert (row.rfc, row.nombre, row.calle, row.numero) == ("R1", "a", None, "2")


def test_nulls_come_first_in_the_master_too(build):
    master = [("K", "R1", "F", "a", "x", "y", "T"), ("K", None, "M", "z", "x", "y", "T")]
    assert only(build([("P", 1, "K")], master)).nombre == "z"


def test_versions_of_a_policy_with_two_parties(build):
    result = build([("P", 1, "K2"), ("P", 1, "K1"), ("P", 2, "K2")])
    assert {(r.num_version, r.cve_asegurado) for r in result.collect()} == {(1, "K1"), (2, "K2")}


def test_profiles_have_one_row_per_usable_key(frame):
    master = [(k, "r", "F", n, None, None, "T", 0) for k in ("A", "B", None, " ") for n in "xy"]
    contacts = [contact(k, calle=c) for k in ("B", "C", None, "") for c in "pq"]
    profiles = smallest_party_rows(frame(master, MASTER), frame(contacts, CONTACTS))
    found = {r[0]: (r[1] and r[1].dnnomrzm, r[2] and r[2].calle) for r in profiles.collect()}
    assert found == {"A": ("x", None), "B": ("x", "p"), "C": (None, "p")}
    assert profiles.count() == 3


def joined_by_hand(policies, master, contacts):
    """All rows of the plain joins, as (policy, master or None, contact or None)."""
    for policy in policies:
        if policy[2] is None or not policy[2].strip(" "):
            continue
        ms = [m for m in master if m[0] == policy[2]] or [None]
        cs = [c for c in contacts if c[0] == policy[2]] or [None]
        yield from product([policy], ms, cs)


def nulls_first(values):
    return [(v is not None, v or "") for v in values]


@pytest.mark.parametrize("seed", range(3))
def test_same_rows_as_joining_first_and_choosing_afterwards(build, seed):
    rng = random.Random(seed)
    keys = ["A", "B", "C", "C ", "D", "\t", " ", "", None]
    some = ["x", "#", "\ty", "", None]
    # Party A holds about a third of each input.
    pick = lambda: "A" if rng.random() < 0.33 else rng.choice(keys)
    policies = [(f"P{rng.randrange(9)}", rng.randrange(3), pick()) for _ in range(80)]
    codes = ["F", "f", " F", "M", None]
    master = [
        (pick(), *rng.choices(some, k=1), rng.choice(codes), *rng.choices(some, k=4))
        for _ in range(25)
    ]
    contacts = [contact(pick(), calle=rng.choice(some), numero=rng.choice(some)) for _ in range(40)]

    best = {}
    for p, m, c in joined_by_hand(policies, master, contacts):
        rank = (
            nulls_first([p[2]]),
            nulls_first((m or [None] * 7)[1:]),
            nulls_first((c or [None] * 23)[1:]),
        )
        row = (p[2], m and m[1], m and m[2], m and m[6], c and c[1], c and c[2])
        best.setdefault(p[:2], []).append((rank, row))
    expected = {key: min(rows)[1] for key, rows in best.items()}

    result = build(policies, master, contacts)
    found = {
        (r.num_poliza, r.num_version): (
            r.cve_asegurado, r.rfc, r.tipo_participante, r.tscdc, r.calle, r.numero,
        )
        for r in result.collect()
    }
    assert result.count() == len(expected)
    assert found == expected

    rng.shuffle(policies)
    rng.shuffle(master)
    rng.shuffle(contacts)
    assert bag(build(policies, master, contacts)) == bag(result)


@pytest.fixture
def stored(frame, tmp_path):
    """The three tables of the job in a format, as their two layers."""

    def write(fmt):
        raw, modelled = str(tmp_path / "raw"), str(tmp_path / "modelled")
        policies = frame([("P", 1, "K", 0), ("Q", 1, " ", 0)], POLICIES)
        io.overwrite_dataset(policies, io.table_path(modelled, "policy_object"), fmt)
        master = frame([("K", "R", "F", "Ana", "Paz", "Gil", "T", 0)], MASTER)
        io.overwrite_dataset(master, io.table_path(raw, "party_master"), fmt)
        contacts = frame([contact("K", calle="c")], CONTACTS)
        io.overwrite_dataset(contacts, io.table_path(modelled, "contact_data"), fmt)
        return raw, modelled

    return write


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_job_replaces_the_table(spark, stored, fmt):
    raw, modelled = stored(fmt)
    for _ in range(2):
        result = plans.run_insured(spark, raw, modelled, fmt=fmt)
        assert only(result).nombre_completo == "Ana Paz Gil"
    assert result.columns == fixed.INSURED_COLUMNS


def test_command_line(spark, stored, monkeypatch):
    raw, modelled = stored("orc")
    options = ["--raw-root", raw, "--modelled-root", modelled, "--format", "orc"]
    monkeypatch.setattr("sys.argv", ["partyfold", *options, "--insured-table", "insured"])
    main()
    assert only(io.read_table(spark, modelled, "insured", "orc")).num_poliza == "P"


def test_session_leaves_given_settings_alone(spark, settings):
    key = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    settings({key: "7MB"})
    assert session("any").conf.get(key) == "7MB"
    spark.conf.unset(key)
    assert session("any").conf.get(key) == "128MB"


def test_names_of_input_columns_may_be_upper_case(frame):
    policies = frame([("P", 1, "K", 0)], POLICIES.replace("num", "NUM").replace("cve", "CVE"))
    master = frame([("K", "R", "F", "Ana", "Paz", "Gil", "T", 0)], MASTER.upper())
    contacts = frame([contact("K", calle="c")], CONTACTS.upper())
    result = plans.insured_flat(policies, master, contacts)
    assert result.columns == fixed.INSURED_COLUMNS
    row = only(result)
    assert (row.rfc, row.calle, row.nombre_completo) == ("R", "c", "Ana Paz Gil")
