"""Build and replace the insured table: `spark-submit` this package, or `python -m` it."""

from __future__ import annotations

import argparse

from partyfold.plans import run_insured
from partyfold.session import session


def main() -> None:
    parser = argparse.ArgumentParser(prog="partyfold", description=__doc__)
    parser.add_argument("--raw-root", required=True, help="layer of the party master")
    parser.add_argument("--modelled-root", required=True, help="layer of all other tables")
    parser.add_argument("--policy-table", default="policy_object")
    parser.add_argument("--master-table", default="party_master")
    parser.add_argument("--contact-table", default="contact_data")
    parser.add_argument("--insured-table", default="insured_flat")
    parser.add_argument("--format", default="parquet", dest="fmt")
    run_insured(session("insured_flat"), **vars(parser.parse_args()))


if __name__ == "__main__":
    main()
