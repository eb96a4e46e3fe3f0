"""Queries and oracle SQL of this subpackage, by name."""

from __future__ import annotations

from .ann import op1_ann
from .bpe import op7_bpe
from .fingerprint import op9_fingerprint
from .jaccard import op3_jaccard
from .language import op8_language
from .licenses import op6_licenses
from .mixing import op4_mixing
from .pii import op2_pii
from .sharding import op5_sharding
from .toxicity import op10_toxicity

QUERIES = {f.__name__: f for f in (op1_ann, op2_pii, op3_jaccard, op4_mixing, op5_sharding, op6_licenses, op7_bpe, op8_language, op9_fingerprint, op10_toxicity)}

ORACLE_SQL: dict[str, str] = {}
