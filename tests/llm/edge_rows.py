"""Rows that every operator must take: see the comment."""

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _id long, label string, rep int"
# null, empty, blank, no letter, long, repeated rows, equal but for case, null columns, clashing extra columns
EDGE = [
    (1, None, None, None, None, 7, "x", 1),
    (2, "", "en", "s", 0, 7, "x", 1),
    (3, " \t\n", "en", "s", 3, None, None, None),
    (4, "12 34!", None, "s", 6, 7, "x", 1),
    (5, "The quick brown fox jumps over the lazy dog", "en", "s", 43, 7, "x", 1),
    (5, "The quick brown fox jumps over the lazy dog", "en", "s", 43, 7, "x", 1),
    (6, "the QUICK brown fox jumps over the lazy dog", "en", None, 43, 7, "x", 1),
    (7, "É", "fr", "s", 1, 7, "x", 1),
    (8, "é", "fr", "s", 1, 7, "x", 1),
    (9, "lorem " * 9000 + "x" * 40000, "la", "s", 94000, 7, "x", 1),
    (None, "no identifier here", "en", "s", 18, 7, "x", 1),
]
