"""Column functions (F1-F12). Every one is a built-in Spark expression, so it stays
inside whole-stage code generation; none needs a Python worker."""

from sparkrisk.functions.scalar import (  # noqa: F401
    array_has,
    as_of_date,
    collapse_double_spaces,
    days_between,
    default_if_blank,
    default_if_null,
    join_words,
    lower_text,
    parse_time,
    remove_slashes,
    replace_text,
    split_words,
    vector_element,
)
