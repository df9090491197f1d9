"""The registered queries of this subpackage and the SQL for those that SQL can express."""

from .bpe import op4_bpe
from .chat import OP10_SQL, op10_perspective_rotation
from .filter_audit import OP11_SQL, op11_filter_audit
from .flat_graph import op1_flat_graph
from .language_id import op9_language_id
from .minhash import op8_minhash
from .mixing import op7_mix_sources
from .ppm import op5_ppm
from .prefix_trie import OP12_SQL, op12_prefix_trie
from .progressive_jpeg import op3_progressive_jpeg
from .quality_rules import op13_quality_rules
from .repeats import op6_suffix_dedup
from .url_filter import OP2_SQL, op2_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_flat_graph,
        op2_url_filter,
        op3_progressive_jpeg,
        op4_bpe,
        op5_ppm,
        op6_suffix_dedup,
        op7_mix_sources,
        op8_minhash,
        op9_language_id,
        op10_perspective_rotation,
        op11_filter_audit,
        op12_prefix_trie,
        op13_quality_rules,
    )
}

ORACLE_SQL: dict[str, str] = {"op2_url_filter": OP2_SQL, "op10_perspective_rotation": OP10_SQL, "op11_filter_audit": OP11_SQL, "op12_prefix_trie": OP12_SQL}
