"""Names: column-name cleaning, folder slugs, id parsing, display strings.

Everything operating on data is a built-in column expression, so it stays in
whole-stage codegen. Column *names* are metadata and are handled in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._compat import as_col

# Characters replaced by "_" in column names, one for one.
NAME_SEPARATORS = " /-"

# Characters a folder slug keeps besides letters and digits.
SLUG_KEEP = " -"


def sanitize_name(name: str) -> str:
    """'Value / Amount - Total' -> 'Value___Amount___Total'."""
    for ch in NAME_SEPARATORS:
        name = name.replace(ch, "_")
    return name


def sanitize_names(names: list[str]) -> list[str]:
    return [sanitize_name(n) for n in names]


def unique_names(names: list[str]) -> tuple[list[str], list[tuple[str, str]]]:
    """Make names unique case-insensitively by appending _2, _3, ...

    Parquet and Spark treat `GEO` and `Geo` as the same column, so names that
    only differ by case (or that became equal after sanitizing) are suffixed.
    Returns the new names and the list of (old, new) renames for the report.
    """
    seen: set[str] = set()
    out, renamed = [], []
    for n in names:
        cand, k = n, 1
        while cand.lower() in seen:
            k += 1
            cand = f"{n}_{k}"
        seen.add(cand.lower())
        out.append(cand)
        if cand != n:
            renamed.append((n, cand))
    return out, renamed


def sanitize_col(c) -> Column:
    """Same rule as `sanitize_name`, applied to a string column."""
    return F.translate(as_col(c), NAME_SEPARATORS, "_" * len(NAME_SEPARATORS))


def folder_slug(product_id, title) -> Column:
    """'<id>-<slug>': keep letters, digits, spaces and '-', lower-case,
    split on spaces and join with '-'. A null title gives '<id>-'."""
    kept = F.regexp_replace(F.coalesce(as_col(title), F.lit("")), r"[^\p{L}\p{N} \-]", "")
    slug = F.regexp_replace(F.trim(F.lower(kept)), " +", "-")
    return F.concat(as_col(product_id).cast("string"), F.lit("-"), slug)


def folder_product_id(folder) -> Column:
    """Strict parse: needs a '-' and an all-digit prefix, else null."""
    f = as_col(folder)
    return F.when(f.rlike("^[0-9]+-"), F.split(f, "-").getItem(0).try_cast("bigint"))


def loose_folder_id(folder) -> Column:
    """Lenient parse used when matching folders to tables: the text before the
    first '-' as an integer (no dash needed), null when it is not one."""
    return F.split(as_col(folder), "-", 2).getItem(0).try_cast("bigint")


def table_product_id(name) -> Column:
    """'<id>_<slug>' -> id; 'catalog', names without '_' or a non-integer
    prefix -> null."""
    n = as_col(name)
    return F.when((n != F.lit("catalog")) & n.contains("_"),
                  F.split(n, "_", 2).getItem(0).try_cast("bigint"))


def display_title(product_id, title, max_len: int = 50) -> Column:
    """'[id] title', the title cut to max_len characters plus '...' when
    strictly longer."""
    t = as_col(title)
    cut = F.when(F.char_length(t) > max_len, F.concat(F.substring(t, 1, max_len), F.lit("..."))).otherwise(t)
    return F.concat(F.lit("["), as_col(product_id).cast("string"), F.lit("] "), cut)


def error_label(error_class, message, max_len: int = 50) -> Column:
    """The message, or the error class name when the message is longer than
    max_len characters."""
    m = as_col(message)
    return F.when(F.char_length(m) > max_len, as_col(error_class)).otherwise(m)


def target_path(prefix: str, folder) -> Column:
    """prefix + folder + '/', the prefix taken verbatim."""
    return F.concat(F.lit(prefix), as_col(folder), F.lit("/"))
