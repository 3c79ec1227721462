"""Shapes of tables."""

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
