"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from .ball_tree import OP11_SQL, op11_ball_tree
from .bpe import op1_bpe
from .chat import OP3_SQL, op3_chat
from .decontaminate import op5_decontaminate
from .importance import OP13_SQL, op13_importance
from .ngram_join import op7_ngram_join
from .ptolemaic import OP12_SQL, op12_ptolemaic
from .quality import op4_quality
from .secrets import op10_secrets
from .substring_dedup import op2_substring_dedup
from .token_counts import op8_token_counts
from .token_files import op9_token_files
from .warc import OP6_SQL, op6_warc_audit

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_chat": op3_chat,
    "op4_quality": op4_quality,
    "op5_decontaminate": op5_decontaminate,
    "op6_warc_audit": op6_warc_audit,
    "op7_ngram_join": op7_ngram_join,
    "op8_token_counts": op8_token_counts,
    "op9_token_files": op9_token_files,
    "op10_secrets": op10_secrets,
    "op11_ball_tree": op11_ball_tree,
    "op12_ptolemaic": op12_ptolemaic,
    "op13_importance": op13_importance,
}
ORACLE: dict[str, str] = {
    "op3_chat": OP3_SQL,
    "op6_warc_audit": OP6_SQL,
    "op11_ball_tree": OP11_SQL,
    "op12_ptolemaic": OP12_SQL,
    "op13_importance": OP13_SQL,
}
