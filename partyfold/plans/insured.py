"""The insured table: one row per policy version with its party and contact data.

The plain way joins every policy row with every master row and every contact row of its
party and drops the surplus at the end. Here each input is reduced to the rows that can
survive before anything is joined. The surviving row is the smallest one, nulls first, by
(party key, master columns, contact columns). The smallest combination of independent
parts is the combination of the smallest parts, so reducing first gives the same row and
the product of the duplicates never exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyfold import fixed
from partyfold.functions import (
    clean_text,
    full_name,
    person_type,
    role,
    text_or_empty,
    usable_key,
)
from partyfold.operators import Spread, first_per_key, left_join_one
from partyfold.sources import (
    overwrite_dataset,
    read_dataset,
    read_table,
    require_types,
    table_path,
)

VERSION = ["num_poliza", "num_version"]
_MASTER, _CONTACT = "__master", "__contact"
_PARTY = "__party"


def policies_with_party(policies: DataFrame) -> DataFrame:
    """Policy rows whose party key is neither null nor blank."""
    return policies.select(*fixed.POLICY_COLUMNS).where(usable_key(F.col("cve_filiacion")))


def smallest_party_rows(master: DataFrame, contacts: DataFrame) -> DataFrame:
    """One row per party key: its smallest master row and its smallest contact row.

    Both tables have the same key, so one aggregation over their union reduces them
    together: one shuffle, after a reduction on the map side, and later one join of the
    policies instead of two. Blank keys cannot match a policy and are left out.
    """
    master_row = F.struct(*fixed.MASTER_COLUMNS)
    contact_row = F.struct(*fixed.CONTACT_COLUMNS)
    master_type = master.select(master_row.alias("row")).schema["row"].dataType
    contact_type = contacts.select(contact_row.alias("row")).schema["row"].dataType

    from_master = master.select(
        F.col(fixed.MASTER_KEY).alias(_PARTY),
        master_row.alias(_MASTER),
        F.lit(None).cast(contact_type).alias(_CONTACT),
    )
    from_contacts = contacts.select(
        F.col(fixed.CONTACT_KEY).alias(_PARTY),
        F.lit(None).cast(master_type).alias(_MASTER),
        contact_row.alias(_CONTACT),
    )
    return (
        from_master.unionByName(from_contacts)
        .where(usable_key(F.col(_PARTY)))
        .groupBy(_PARTY)
        .agg(F.min(_MASTER).alias(_MASTER), F.min(_CONTACT).alias(_CONTACT))
    )


def party_profiles(master: DataFrame, contacts: DataFrame) -> DataFrame:
    """All output columns of a party, one row per party key.

    Names are cleaned here, once per party, and not once per policy version.
    """
    party, contact = F.col(_MASTER), F.col(_CONTACT)
    code = F.col("tipo_participante")
    return (
        smallest_party_rows(master, contacts)
        .select(
            _PARTY,
            party["cdrfc"].cast(T.StringType()).alias("rfc"),
            party["tcpefiju"].alias("tipo_participante"),
            clean_text(party["dnnomrzm"]).alias("nombre"),
            clean_text(party["dnap1rzm"]).alias("primer_apellido"),
            clean_text(party["dnap2rzm"]).alias("segundo_apellido"),
            *[contact[c].alias(c) for c in fixed.CONTACT_COLUMNS],
            party["tscdc"].alias("tscdc"),
        )
        .withColumns(
            {
                "desc_tipo_persona": person_type(code),
                "nombre_completo": full_name(
                    code, F.col("nombre"), F.col("primer_apellido"), F.col("segundo_apellido")
                ),
            }
        )
    )


def insured_flat(
    policies: DataFrame, master: DataFrame, contacts: DataFrame, spread: bool = True
) -> DataFrame:
    """The 34 columns of the insured table, one row per policy and version.

    `spread` deals out the policies of a party that holds many of them, at the price of
    counting the parties first; turn it off where the parties are few enough to be broadcast.

    Policies of parties that the master does not know are kept: their master columns are
    null, the label is the one of a legal person and the full name is empty.
    """
    usable = policies_with_party(policies)
    versions = first_per_key(usable, VERSION)
    return insured_versions(versions, master, contacts, Spread(by=VERSION, counted=usable) if spread else None)


def insured_versions(
    versions: DataFrame, master: DataFrame, contacts: DataFrame, how: Spread | None = None
) -> DataFrame:
    """The same from the one policy row that each version has left."""
    profiles = party_profiles(master, contacts)
    joined = left_join_one(versions, profiles, ["cve_filiacion"], [_PARTY], how)
    unknown_label = F.lit(fixed.LEGAL_PERSON_LABEL)
    return joined.withColumns(
        {
            "cve_asegurado": F.col("cve_filiacion"),
            "desc_tipo_persona": F.coalesce(F.col("desc_tipo_persona"), unknown_label),
            "nombre_completo": text_or_empty(F.col("nombre_completo")),
            "ind_rol": role(),
        }
    ).select(*fixed.INSURED_COLUMNS)


def register_views(views: dict[str, DataFrame]) -> None:
    """Give the inputs names for SQL text run with `spark.sql`."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def run_insured(
    spark: SparkSession,
    raw_root: str,
    modelled_root: str,
    policy_table: str = "policy_object",
    master_table: str = "party_master",
    contact_table: str = "contact_data",
    insured_table: str = "insured_flat",
    fmt: str = "parquet",
    spread: bool = True,
) -> DataFrame:
    """The whole job: read the three tables, check them, build the insured table, replace it.

    A column that is missing, or is not text where text is expected, is an error before anything runs.
    """
    text = T.StringType()
    policies = require_types(
        read_table(spark, modelled_root, policy_table, fmt),
        {c: text if c == "cve_filiacion" else None for c in fixed.POLICY_COLUMNS},
    )
    master = require_types(
        read_table(spark, raw_root, master_table, fmt),
        dict.fromkeys([fixed.MASTER_KEY, *fixed.MASTER_COLUMNS], text),
    )
    contacts = require_types(
        read_table(spark, modelled_root, contact_table, fmt),
        dict.fromkeys([fixed.CONTACT_KEY, *fixed.CONTACT_COLUMNS], text),
    )
    result = insured_flat(policies, master, contacts, spread)
    target = table_path(modelled_root, insured_table)
    overwrite_dataset(result, target, fmt)
    return read_dataset(spark, target, fmt)
