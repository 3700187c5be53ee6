"""Column expressions: text repair, party attributes, date pieces."""

from partyfold.functions.dates import date_stamp, day_of_month, is_day_of_month
from partyfold.functions.fingerprint import row_fingerprint
from partyfold.functions.party import full_name, person_type, role
from partyfold.functions.text import clean_text, text_or_empty, usable_key

__all__ = [
    "clean_text",
    "date_stamp",
    "day_of_month",
    "full_name",
    "is_day_of_month",
    "person_type",
    "role",
    "row_fingerprint",
    "text_or_empty",
    "usable_key",
]
