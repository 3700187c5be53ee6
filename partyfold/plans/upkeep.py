"""The insured table kept up by changes, instead of built anew.

A row of the insured table depends on the smallest usable policy row of its version and on
the smallest master and contact row of that row's party. So it can change only if

- a policy row of its version came, went or changed, or
- a master or contact row of its own party did. Which versions belong to a party is looked up
  in the insured table, which holds one row for each; the policies are not searched by party.

The comparison that finds the versions with changed policies also finds the smallest party they have now.
The others are only moved by their party: they keep it, and the insured table says which it is. So the
policies are read for the comparison and not again. For the parties that all these versions have now the master and
the contacts are read. The smallest row that is left after a deletion is found among the rows that are there, and nothing has to be remembered for it. All other rows stay as they are.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyfold import fixed
from partyfold.operators import (
    Spread,
    changed_keys,
    distinct_rows,
    first_per_key,
    matched_rows,
    unmatched_rows,
)
from partyfold.plans.insured import VERSION, insured_versions, policies_with_party
from partyfold.sources import overwrite_dataset, read_dataset, scratch

_PARTY = "party"


@dataclass(frozen=True)
class InsuredInputs:
    """The three tables that the insured table is made of, as they are at one time."""

    policies: DataFrame
    master: DataFrame
    contacts: DataFrame


def changed_versions(old: InsuredInputs, new: InsuredInputs) -> DataFrame:
    """Versions of which a usable policy row came, went or changed, with the smallest party they have now.

    The party of a version that is gone is null.
    """
    before, after = policies_with_party(old.policies), policies_with_party(new.policies)
    return changed_keys(before, after, VERSION, smallest=["cve_filiacion"]).select(*VERSION, "cve_filiacion")


def changed_parties(old: InsuredInputs, new: InsuredInputs) -> DataFrame:
    """Parties of which a master or contact row came, went or changed."""

    def changes(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
        taken = [df.select(key, *columns) for df in (before, after)]
        return changed_keys(*taken, [key]).select(F.col(key).alias(_PARTY))

    masters = changes(old.master, new.master, fixed.MASTER_KEY, fixed.MASTER_COLUMNS)
    contacts = changes(old.contacts, new.contacts, fixed.CONTACT_KEY, fixed.CONTACT_COLUMNS)
    return distinct_rows(masters.unionAll(contacts).where(F.col(_PARTY).isNotNull()))


def _versions_of(insured: DataFrame, parties: DataFrame, spread: bool) -> DataFrame:
    """Version and party of the rows of some parties."""
    how = Spread(by=VERSION) if spread else None
    return matched_rows(insured.select(*VERSION, "cve_asegurado"), parties, ["cve_asegurado"], [_PARTY], how)


def affected_versions(
    insured: DataFrame, versions: DataFrame, parties: DataFrame, spread: bool = True
) -> DataFrame:
    """Versions that can change: the changed ones and those of changed parties.

    `spread` deals out the versions of a party that holds many of them.
    """
    of_parties = _versions_of(insured, parties, spread)
    return distinct_rows(versions.select(*VERSION).unionByName(of_parties.select(*VERSION)))


def moved_policies(
    insured: DataFrame, versions: DataFrame, parties: DataFrame, spread: bool = True
) -> DataFrame:
    """Versions of changed parties that are not among the changed versions, as policy rows with the party they keep."""
    moved = unmatched_rows(_versions_of(insured, parties, spread), versions, VERSION, null_safe=True)
    return moved.withColumnRenamed("cve_asegurado", "cve_filiacion")


def rebuilt_versions(
    inputs: InsuredInputs, affected: DataFrame, spread: bool = True, policies: DataFrame | None = None
) -> DataFrame:
    """The rows of the insured table for some versions, from the inputs as they are now.

    `policies` are the smallest policy rows of the affected versions, where they have been found already.
    """

    def rows(table: DataFrame, keys: DataFrame, own: list[str], by: list[str], null_safe: bool = False) -> DataFrame:
        how = Spread(by=by) if spread else None
        return matched_rows(table, keys, own, keys.columns, how, null_safe)

    if policies is None:
        usable = policies_with_party(inputs.policies)
        own = rows(usable, affected.select(*VERSION), VERSION, ["cve_filiacion"], null_safe=True)
        policies = first_per_key(own, VERSION)
    needed = distinct_rows(policies.select(F.col("cve_filiacion").alias(_PARTY)))
    master = rows(inputs.master, needed, [fixed.MASTER_KEY], fixed.MASTER_COLUMNS)
    contacts = rows(inputs.contacts, needed, [fixed.CONTACT_KEY], fixed.CONTACT_COLUMNS)
    return insured_versions(policies, master, contacts, Spread(by=VERSION) if spread else None)


def insured_upkeep(
    insured: DataFrame,
    inputs: InsuredInputs,
    affected: DataFrame,
    spread: bool = True,
    parties: DataFrame | None = None,
    policies: DataFrame | None = None,
) -> DataFrame:
    """The insured table after a change: affected versions rebuilt, the others kept.

    All versions of `parties` are affected as well; `policies` are then the smallest policy rows of all that are.
    The parties are far fewer than their versions, so rows go by their party first and what is left by its version.
    """
    if parties is not None and policies is None:
        raise ValueError("give the policies of the parties' versions")
    kept = insured
    if parties is not None:
        kept = unmatched_rows(kept, parties, ["cve_asegurado"], [_PARTY], spread=Spread(by=VERSION) if spread else None)
    kept = unmatched_rows(kept, affected, VERSION, null_safe=True)  # one row for each key
    return kept.unionByName(rebuilt_versions(inputs, affected, spread, policies))


def refresh_insured(
    path: str, old: InsuredInputs, new: InsuredInputs, fmt: str = "parquet", spread: bool = True
) -> DataFrame:
    """Bring a stored insured table from the old inputs to the new ones.

    Changed versions, changed parties and the policy rows of the affected versions are written to scratch
    once, so that the inputs are compared only once. The two comparisons run side by side: that of the parties is the smaller one.
    """
    spark = new.policies.sparkSession
    insured = read_dataset(spark, path, fmt)
    with scratch(spark) as folder:

        def stored(name: str, df: DataFrame) -> DataFrame:
            df.write.parquet(f"{folder}/{name}")
            return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

        with ThreadPoolExecutor(max_workers=2) as pool:
            changes = changed_versions(old, new), changed_parties(old, new)
            versions, parties = pool.map(stored, ("versions", "parties"), changes)
        present = versions.where(F.col("cve_filiacion").isNotNull())
        moved = moved_policies(insured, versions.select(*VERSION), parties, spread)
        policies = stored("policies", present.unionByName(moved))
        kept_up = insured_upkeep(insured, new, versions.select(*VERSION), spread, parties, policies)
        overwrite_dataset(kept_up, path, fmt)
    return read_dataset(spark, path, fmt)
