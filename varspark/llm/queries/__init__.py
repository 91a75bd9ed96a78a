"""The registered queries of this subpackage: ``queries()`` and ``oracle_sql()``."""

from . import ann, edits, fertility, html, jaccard, lines, lm, media, merkle, mixing, packing, quality, resample

_MODULES = (mixing, packing, media, html, quality, jaccard, edits, ann, lines, lm, fertility, resample, merkle)


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.ORACLE_SQL.items()}
