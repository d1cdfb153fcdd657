"""Queries of this subpackage, by name, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from lakespan.llm.chat import OP8_SQL, op8_chat_format
from lakespan.llm.decontam import op9_decontamination
from lakespan.llm.langid import op1_language_id
from lakespan.llm.minhash import op2_minhash_dedup
from lakespan.llm.packing import op5_best_fit_packing
from lakespan.llm.quality import op3_quality_classifier
from lakespan.llm.rules import op7_quality_rules
from lakespan.llm.sharding import op10_sharding
from lakespan.llm.urlfilter import OP6_SQL, op6_url_filter
from lakespan.llm.warc import OP4_SQL, op4_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_minhash_dedup, op3_quality_classifier, op4_warc, op5_best_fit_packing,
        op6_url_filter, op7_quality_rules, op8_chat_format, op9_decontamination, op10_sharding,
    )
}
ORACLE_SQL = {"op4_warc": OP4_SQL, "op6_url_filter": OP6_SQL, "op8_chat_format": OP8_SQL}
