"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from .op1_jaccard import op1_jaccard
from .op2_rans import op2_rans
from .op3_quality import op3_quality
from .op4_suffix import op4_suffix
from . import op5_warc, op11_merkle, op12_audit, op13_urlfilter
from .op6_ego import op6_ego
from .op7_license import op7_license
from .op8_lm import op8_lm
from .op9_pii import op9_pii
from .op10_bpe import op10_bpe

QUERIES = {"op1_jaccard": op1_jaccard, "op2_rans": op2_rans, "op3_quality": op3_quality, "op4_suffix": op4_suffix, "op5_warc": op5_warc.op5_warc, "op6_ego": op6_ego, "op7_license": op7_license, "op8_lm": op8_lm, "op9_pii": op9_pii, "op10_bpe": op10_bpe, "op11_merkle": op11_merkle.op11_merkle, "op12_audit": op12_audit.op12_audit, "op13_urlfilter": op13_urlfilter.op13_urlfilter}
SQL: dict[str, str] = {"op5_warc": op5_warc.SQL, "op11_merkle": op11_merkle.SQL, "op12_audit": op12_audit.SQL, "op13_urlfilter": op13_urlfilter.SQL}
