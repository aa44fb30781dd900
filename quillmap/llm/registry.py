"""The queries op1 to op10 and the SQL for those that SQL can express."""

from . import bpe, crosspoly, kmtree, langid, linededup, lmscore, mixing, nearset, oracles, suffixes, warc

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_minhash": nearset.op2_minhash,
    "op3_line_dedup": linededup.op3_line_dedup,
    "op4_lm_score": lmscore.op4_lm_score,
    "op5_suffix_dedup": suffixes.op5_suffix_dedup,
    "op6_langid": langid.op6_langid,
    "op7_crosspoly": crosspoly.op7_crosspoly,
    "op8_warc": warc.op8_warc,
    "op9_mixing": mixing.op9_mixing,
    "op10_kmtree": kmtree.op10_kmtree,
}
ORACLES = {
    "op2_minhash": oracles.NEAR_SETS,
    "op3_line_dedup": linededup.ORACLE,
    "op5_suffix_dedup": oracles.REPEATS,
    "op7_crosspoly": crosspoly.ORACLE,
    "op8_warc": warc.ORACLE,
}
