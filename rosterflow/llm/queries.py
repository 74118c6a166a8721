"""All queries of the text operators; importing the modules registers them."""

from rosterflow.llm import (  # noqa: F401
    class_lm, edit_fingerprint, language_id, line_dedup, merkle_manifest, near_dedup, ngram_join, quality_rules, sentencepiece_codec, source_mixing,
    substring_dedup, vector_codes, warc_archive,
)
from rosterflow.llm.common import ORACLES, QUERIES  # noqa: F401
