"""Queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from . import containment, fill_middle, importance, warc
from .html_templates import op1_html
from .language_id import op5_language
from .offset_pieces import op13_pieces
from .packing import op10_packing
from .pca_tiles import op3_embeddings
from .quality_fm import op7_quality
from .secrets import op6_secrets
from .simhash_vptree import op2_simhash
from .suffix_dedup import op9_suffix_dedup

QUERIES = {
    "op1_html": op1_html,
    "op2_simhash": op2_simhash,
    "op3_embeddings": op3_embeddings,
    "op4_warc": warc.op4_warc,
    "op5_language": op5_language,
    "op6_secrets": op6_secrets,
    "op7_quality": op7_quality,
    "op8_containment": containment.op8_containment,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_packing": op10_packing,
    "op11_importance": importance.op11_importance,
    "op12_fill_middle": fill_middle.op12_fill_middle,
    "op13_pieces": op13_pieces,
}
ORACLE_SQL: dict[str, str] = {"op4_warc": warc.ORACLE, "op8_containment": containment.ORACLE,
                              "op11_importance": importance.ORACLE, "op12_fill_middle": fill_middle.ORACLE}
