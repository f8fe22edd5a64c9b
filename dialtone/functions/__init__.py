from .scalar import (  # noqa: F401
    CLEAN_INT_DEFAULT, all_known, classify_label, clean_int, date_id, flag, is_known,
    whole_hours_between,
)
from .sql_functions import create_clean_int, drop_clean_int, register_clean_int  # noqa: F401
