"""Scalar and aggregate column expressions.

All are built-in Spark expressions, so they stay inside whole-stage codegen
(or the object-hash aggregate for ``distinct_concat``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsheet import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_labels(*parts) -> Column:
    """SQL ``CONCAT``: NULL if any part is NULL; non-strings cast to text.

    Strings given as plain Python ``str`` that are not column names must be
    passed as ``F.lit``.
    """
    return F.concat(*[_c(p).cast("string") for p in parts])


def format_date(c) -> Column:
    """``dd-MM-yyyy``, zero padded (dates or timestamps)."""
    return F.date_format(_c(c), K.DATE_FORMAT)


def agreement_type(qtd) -> Column:
    """1 instalment -> AVISTA, more -> PARCELADO, else (0, negative, NULL) NULL."""
    q = _c(qtd)
    return F.when(q == 1, F.lit(K.TYPE_SINGLE)).when(q > 1, F.lit(K.TYPE_INSTALMENTS))


def agreement_status_label(staco) -> Column:
    """Status code -> label; unknown codes (and NULL) -> 'Sem Dados'."""
    s = _c(staco)
    out = F.lit(K.STATUS_LABEL_OTHER)
    for code, label in reversed(K.STATUS_LABELS):
        out = F.when(s == code, F.lit(label)).otherwise(out)
    return out


def field_order(status, order=K.PHONE_STATUS_ORDER) -> Column:
    """1-based position of ``status`` in ``order``; 0 when absent or NULL.

    So statuses outside the list (and NULL) rank *before* every listed one.
    """
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), _c(status))
    return F.coalesce(pos, F.lit(0)).cast("int")


def fold(c) -> Column:
    """Text as a collation compares it that ignores case and trailing blanks."""
    return F.lower(F.rtrim(_c(c)))


def cut_bytes(c, most: int) -> Column:
    """The longest beginning of a text that has at most ``most`` bytes of UTF-8; no character is cut."""
    c = _c(c)
    raw = F.encode(c, "UTF-8")
    # a character has four bytes at most, so one of these ends is between two
    ends = [F.try_validate_utf8(F.substring(raw, 1, max(0, most - k)).cast("string")) for k in range(4)]
    return F.when(F.octet_length(c) <= most, c).otherwise(F.coalesce(*ends))


def _one_of_each_key(spelled: Column) -> Column:
    """``shown`` of the first of each ``key`` in a sorted array of (key, shown)."""
    first = F.filter(spelled, lambda v, i: (i == 0) | (v["key"] != F.get(spelled, i - 1)["key"]))
    return F.transform(first, lambda v: v["shown"])


def distinct_concat(col: str, sep: str = K.LIST_SEPARATOR, folded: bool = False, max_bytes: int | None = None) -> Column:
    """Aggregate: distinct non-NULL values, ascending, joined by ``sep``.

    All-NULL (or empty) group -> NULL.  The text is cut only if ``max_bytes``
    is given, then between two characters.  With ``folded``, values that
    differ in case or trailing blanks are one (the least of them is shown) and
    stand in their folded order.

    Built on ``collect_set``: its buffer de-duplicates map-side, so the
    aggregate needs one exchange (``listagg(DISTINCT ...) WITHIN GROUP``
    plans two, and Spark 4.1 cannot run two of those in one aggregate).
    Only the distinct values of one group meet in one task -- exactly the
    size of that group's result string (with ``folded``, of all spellings).
    """
    if folded:
        found = F.collect_set(F.when(F.col(col).isNotNull(), F.struct(fold(col).alias("key"), F.col(col).alias("shown"))))
        # the sorted list is named by a lambda over it alone: an expression in a lambda's body is worked out for each element again
        values = F.get(F.transform(F.array(F.sort_array(found)), _one_of_each_key), 0)
    else:
        found = F.collect_set(F.col(col))
        values = F.array_sort(found)
    text = F.when(F.size(found) > 0, F.array_join(values, sep))
    return text if max_bytes is None else cut_bytes(text, max_bytes)
