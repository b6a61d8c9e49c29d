"""The registered queries of the subpackage and their SQL."""

from reglink.llm import bpe, decontaminate, dialogs, language, licenses, lines, minhash, packing, quality, secrets, spelling, substrings, warc
from reglink.llm.oracle import ORACLE_SQL  # noqa: F401

QUERIES = {
    "op1_length_buckets": packing.op1_length_buckets,
    "op2_near_duplicates": minhash.op2_near_duplicates,
    "op3_secret_scan": secrets.op3_secret_scan,
    "op4_substring_dedup": substrings.op4_substring_dedup,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_language_id": language.op7_language_id,
    "op8_line_chunks": lines.op8_line_chunks,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_warc_fixity": warc.op10_warc_fixity,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_conversation_repair": dialogs.op12_conversation_repair,
    "op13_byte_bpe": bpe.op13_byte_bpe,
}
