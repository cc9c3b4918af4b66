"""Shared by the tests of the llm operators."""

import re

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    """The words of the decontamination contract."""
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def clashing(df):
    """The table with columns named as the operators name their own."""
    return df.withColumns({c: F.lit("x") for c in ("fp", "fingerprint", "component_id", "root", "text_key", "kept_id", "kept_text", "repeated", "hit_id", "hit_text",
                                                   "bp_host", "bp_digests", "bp_lines", "bp_kept", "n_lines", "lang_pred", "score", "pos", "token", "win", "kind")})
