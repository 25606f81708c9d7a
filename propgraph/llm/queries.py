"""The registered queries of this package, and SQL where it can say the same."""

import corpus_pipeline
from propgraph.llm.ball_tree import OP12_SQL, op12_lexical_search
from propgraph.llm.byte_bpe import op11_byte_bpe
from propgraph.llm.chat import OP10_SQL, op10_chat_format
from propgraph.llm.decontaminate import op9_decontaminate
from propgraph.llm.iceberg import OP13_SQL, op13_divergence
from propgraph.llm.jaccard_join import op8_jaccard_join
from propgraph.llm.license_scan import op7_license_scan
from propgraph.llm.line_dedup import OP6_SQL, op6_line_dedup
from propgraph.llm.mixing import op5_mixing
from propgraph.llm.secret_scan import op1_secret_scan
from propgraph.llm.toxicity import op2_toxicity
from propgraph.llm.url_filter import OP3_SQL, op3_url_filter
from propgraph.llm.vector_graph import op4_vector_graph

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_toxicity": op2_toxicity,
    "op3_url_filter": op3_url_filter,
    "op4_vector_graph": op4_vector_graph,
    "op5_mixing": op5_mixing,
    "op6_line_dedup": op6_line_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_decontaminate": op9_decontaminate,
    "op10_chat_format": op10_chat_format,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_lexical_search": op12_lexical_search,
    "op13_divergence": op13_divergence,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op3_url_filter": OP3_SQL,
    "op6_line_dedup": OP6_SQL,
    "op10_chat_format": OP10_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_divergence": OP13_SQL,
}
