"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .attention import op3_attention
from .chat import op10_chat
from .decontamination import op2_decontamination
from . import chat, decontamination, line_dedup, mixing, prefix_trie, quality_rules, recompression, secrets, structure, suffix_array
from .line_dedup import op9_line_dedup
from .minhash import op1_minhash
from .mixing import op8_mixing
from .packing import op12_packing
from .prefix_trie import op13_prefix_trie
from .quality_rules import op4_quality_rules
from .recompression import op6_recompression
from .secrets import op7_secrets
from .structure import op11_structure_repair
from .suffix_array import op5_suffix_array


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash": op1_minhash,
        "op2_decontamination": op2_decontamination,
        "op3_attention": op3_attention,
        "op4_quality_rules": op4_quality_rules,
        "op5_suffix_array": op5_suffix_array,
        "op6_recompression": op6_recompression,
        "op7_secrets": op7_secrets,
        "op8_mixing": op8_mixing,
        "op9_line_dedup": op9_line_dedup,
        "op10_chat": op10_chat,
        "op11_structure_repair": op11_structure_repair,
        "op12_packing": op12_packing,
        "op13_prefix_trie": op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": decontamination.ORACLE_SQL,
        "op4_quality_rules": quality_rules.ORACLE_SQL,
        "op5_suffix_array": suffix_array.ORACLE_SQL,
        "op6_recompression": recompression.ORACLE_SQL,
        "op7_secrets": secrets.ORACLE_SQL,
        "op8_mixing": mixing.ORACLE_SQL,
        "op9_line_dedup": line_dedup.ORACLE_SQL,
        "op10_chat": chat.ORACLE_SQL,
        "op11_structure_repair": structure.ORACLE_SQL,
        "op13_prefix_trie": prefix_trie.ORACLE_SQL,
    }
