"""The registered queries of this package and their SQL."""

from __future__ import annotations

from .block_search import OP7_SQL, op7_block_search
from .bpe import op8_bpe
from .html_extract import op9_html_extract
from .jaccard_join import op5_jaccard_join
from .license_scan import op6_license_scan
from .metric_tree_codes import OP12_SQL, op12_vector_codes
from .mixing import OP1_SQL, op1_mixing
from .oracle_sql import OP4_SQL, OP5_SQL, OP10_SQL
from .projection_dedup import op10_projection_dedup
from .quality_crf import op2_quality_crf
from .secret_scan import op3_secret_scan
from .spectrum_whitening import op13_spectrum_whitening
from .suffix_dedup import op4_suffix_dedup
from .warc_index import OP11_SQL, op11_warc_index

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_quality_crf": op2_quality_crf,
    "op3_secret_scan": op3_secret_scan,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_license_scan": op6_license_scan,
    "op7_block_search": op7_block_search,
    "op8_bpe": op8_bpe,
    "op9_html_extract": op9_html_extract,
    "op10_projection_dedup": op10_projection_dedup,
    "op11_warc_index": op11_warc_index,
    "op12_vector_codes": op12_vector_codes,
    "op13_spectrum_whitening": op13_spectrum_whitening,
}

ORACLE_SQL = {
    "op1_mixing": OP1_SQL,
    "op4_suffix_dedup": OP4_SQL,
    "op5_jaccard_join": OP5_SQL,
    "op7_block_search": OP7_SQL,
    "op10_projection_dedup": OP10_SQL,
    "op11_warc_index": OP11_SQL,
    "op12_vector_codes": OP12_SQL,
}
