"""Column -> Column builders for the label rules.

All of them compile to built-in Catalyst expressions (no Python UDF), so
they stay inside whole-stage codegen.  Codes taken from data are matched
literally (``startswith``/``endswith``/``contains``): a ``%`` or ``_`` in a
code is an ordinary character, not a LIKE wildcard.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_all(c: str | Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal replace of every occurrence, applied pair after pair."""
    out = col(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def strip_leading_label(c: str | Column, prefixes: Sequence[str]) -> Column:
    """When the value starts with one of ``prefixes`` (first match wins), remove
    every occurrence of that prefix text; otherwise keep the value."""
    c = col(c)
    out = None
    for p in prefixes:
        branch = F.replace(c, F.lit(p), F.lit(""))
        out = F.when(c.startswith(p), branch) if out is None else out.when(c.startswith(p), branch)
    return c if out is None else out.otherwise(c)


def map_lookup(c: str | Column, mapping: Mapping[str, str] | Iterable[tuple[str, str]]) -> Column:
    """Value of ``c`` in a literal map, null when absent (a hash lookup, not a CASE chain)."""
    items = list(mapping.items()) if isinstance(mapping, Mapping) else list(mapping)
    if not items:
        return F.lit(None).cast("string")
    m = F.create_map(*[F.lit(x) for kv in items for x in kv])
    return F.try_element_at(m, col(c))


def recode_in_scope(c: str | Column, in_scope: Column,
                    mapping: Mapping[str, str] | Iterable[tuple[str, str]]) -> Column:
    """Inside the scope, replace mapped values; elsewhere (or unmapped) keep."""
    c = col(c)
    return F.when(in_scope, F.coalesce(map_lookup(c, mapping), c)).otherwise(c)


def is_own_period(period: str | Column, peer: str | Column,
                  special: tuple[str, str] | None = None) -> Column:
    """True when the period label names the row's own peer: equal to it, or
    starting ``peer + ' '``, ending ``' ' + peer``, containing ``' ' + peer + ' '``;
    plus the special (period, peer-prefix) pair."""
    period, peer = col(period), col(peer)
    sp = F.lit(" ")
    cond = (period.endswith(F.concat(sp, peer))
            | (period == peer)
            | period.startswith(F.concat(peer, sp))
            | period.contains(F.concat(sp, peer, sp)))
    if special is not None:
        cond = cond | ((period == F.lit(special[0])) & peer.startswith(special[1]))
    return cond


def category_average(group: str | Column, peer: str | Column, report: str | Column,
                     exempt_report: str, eaa_prefix: str, hedged_suffix: str,
                     hedged_tail: int, other_prefixes: Sequence[str],
                     label: str) -> Column:
    """Category-average label of a peer-group row, or the group itself."""
    group, peer, report = col(group), col(peer), col(report)
    base = F.concat(peer, F.lit(label))
    hedged = F.concat(peer, F.lit(label + " "), F.substring(group, -hedged_tail, hedged_tail))
    inner = F.when(group.startswith(eaa_prefix),
                   F.when(group.endswith(hedged_suffix), hedged).otherwise(base))
    for p in other_prefixes:
        inner = inner.when(group.startswith(p), base)
    return F.when(report != F.lit(exempt_report), inner.otherwise(group)).otherwise(group)
