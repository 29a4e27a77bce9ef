"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from lexloom.llm import collocations, line_dedup, mixing, near_dup, secrets, spelling
from lexloom.llm.audio import op9_audio
from lexloom.llm.bpe import op1_bpe
from lexloom.llm.collocations import op13_collocations
from lexloom.llm.lattice_lm import op8_lattice_lm
from lexloom.llm.line_dedup import op3_line_dedup
from lexloom.llm.mixing import op7_mixing
from lexloom.llm.near_dup import op4_near_dup
from lexloom.llm.order_minhash import op10_order_minhash
from lexloom.llm.quality_knn import op5_quality_knn
from lexloom.llm.secrets import op6_secrets
from lexloom.llm.shards import op2_sharding
from lexloom.llm.spelling import op11_spelling
from lexloom.llm.token_files import op12_token_files

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_sharding": op2_sharding,
    "op3_line_dedup": op3_line_dedup,
    "op4_near_dup": op4_near_dup,
    "op5_quality_knn": op5_quality_knn,
    "op6_secrets": op6_secrets,
    "op7_mixing": op7_mixing,
    "op8_lattice_lm": op8_lattice_lm,
    "op9_audio": op9_audio,
    "op10_order_minhash": op10_order_minhash,
    "op11_spelling": op11_spelling,
    "op12_token_files": op12_token_files,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op3_line_dedup": line_dedup.ORACLE,
    "op4_near_dup": near_dup.ORACLE,
    "op6_secrets": secrets.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op11_spelling": spelling.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
