from rootweave.functions.rules import (
    better_root,
    key_as_long,
    key_as_string,
    not_blank,
    open_ended,
    table_name_of,
)

__all__ = ["better_root", "key_as_long", "key_as_string", "not_blank", "open_ended", "table_name_of"]
