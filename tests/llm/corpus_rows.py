"""Rows that every corpus operator has to take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, n_words string, _row string, columns string"
LONG = " ".join(f"word{i % 700}" for i in range(30_000))
ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", None, 4), (None, "no id here", None, "b", None),
    (None, None, None, None, None), (5, "same text " * 30, "en", "b", 1), (5, "same text " * 30, "en", "b", 1),
    (6, "same text " * 30, "en", "b", 1), (7, LONG, "de", "c", 2), (8, "é漢😀 " * 80, "fr", "c", 3), (9, "x" * 5000, "en", "a", 4),
]
