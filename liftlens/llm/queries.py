"""The registered queries of this subpackage and their DuckDB SQL."""

from liftlens.llm import (audit, bpe, centroids, decontaminate, langid, licenses, packing, pst,
                          sharding, simhash, suffix_dedup, topk, toxicity)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_topk": topk.op2_topk,
    "op3_simhash": simhash.op3_simhash,
    "op4_langid": langid.op4_langid,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_packing": packing.op6_packing,
    "op7_pst": pst.op7_pst,
    "op8_licenses": licenses.op8_licenses,
    "op9_sharding": sharding.op9_sharding,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_audit": audit.op11_audit,
    "op12_bpe": bpe.op12_bpe,
    "op13_centroids": centroids.op13_centroids,
}

ORACLE_SQL = {
    "op2_topk": topk.ORACLE_SQL,
    "op10_decontaminate": decontaminate.ORACLE_SQL,
    "op11_audit": audit.ORACLE_SQL,
    "op13_centroids": centroids.ORACLE_SQL,
}
