"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from .decontaminate import OP2_SQL, op2_decontaminate
from .fuzzy_hash import op3_fuzzy_hash
from .language_id import op4_language_id
from .license_scan import OP8_SQL, op8_license_scan
from .line_dedup import OP7_SQL, op7_line_dedup
from .mixing import OP6_SQL, op6_mixing
from .near_dedup import op10_near_dedup
from .pii import op1_pii
from .repeats import op9_repeats
from .url_filter import URL_RULES_SQL, op5_url_filter, url_rules

_QUERIES = [
    op1_pii,
    op2_decontaminate,
    op3_fuzzy_hash,
    op4_language_id,
    op5_url_filter,
    op6_mixing,
    op7_line_dedup,
    op8_license_scan,
    op9_repeats,
    op10_near_dedup,
    url_rules,
]
_SQL = {"op2_decontaminate": OP2_SQL, "op6_mixing": OP6_SQL, "op7_line_dedup": OP7_SQL, "op8_license_scan": OP8_SQL, "url_rules": URL_RULES_SQL}


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return _SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
