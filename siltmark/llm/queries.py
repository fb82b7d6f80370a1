"""The queries of this subpackage and their SQL."""

from siltmark.llm.bpe import op5_bpe
from siltmark.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from siltmark.llm.mixing import OP2_SQL, op2_source_mixing
from siltmark.llm.near_dedup import OP7_SQL, op7_near_dedup
from siltmark.llm.pii import op9_pii
from siltmark.llm.quality_classifier import op4_quality_classifier
from siltmark.llm.quality_rules import OP8_SQL, op8_quality_rules
from siltmark.llm.secret_scan import op3_secret_scan
from siltmark.llm.token_rollup import OP6_SQL, op6_token_rollup
from siltmark.llm.warc import OP1_SQL, op1_warc


def queries():
    return {
        "op1_warc": op1_warc,
        "op2_source_mixing": op2_source_mixing,
        "op3_secret_scan": op3_secret_scan,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_bpe": op5_bpe,
        "op6_token_rollup": op6_token_rollup,
        "op7_near_dedup": op7_near_dedup,
        "op8_quality_rules": op8_quality_rules,
        "op9_pii": op9_pii,
        "op10_exact_dedup": op10_exact_dedup,
    }


def oracle_sql():
    return {"op1_warc": OP1_SQL, "op2_source_mixing": OP2_SQL, "op6_token_rollup": OP6_SQL, "op7_near_dedup": OP7_SQL, "op8_quality_rules": OP8_SQL, "op10_exact_dedup": OP10_SQL}
