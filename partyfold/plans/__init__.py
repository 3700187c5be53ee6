"""Whole jobs made of operators."""

from partyfold.plans.figures import daily_figures, kept_figures, refresh_figures, store_figures
from partyfold.plans.insured import insured_flat, register_views, run_insured
from partyfold.plans.loads import loaded_table, runs_whole_history
from partyfold.plans.upkeep import InsuredInputs, affected_versions, insured_upkeep, refresh_insured

__all__ = [
    "InsuredInputs",
    "affected_versions",
    "daily_figures",
    "insured_flat",
    "insured_upkeep",
    "kept_figures",
    "loaded_table",
    "refresh_figures",
    "refresh_insured",
    "register_views",
    "run_insured",
    "runs_whole_history",
    "store_figures",
]
