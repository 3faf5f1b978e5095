"""Rows with nulls, empty and very long texts, ties and repeated rows."""

LONG = " ".join(f"word{k % 977}x{k % 31}" for k in range(60_000)) + "\n" + "é😀 tail"
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\r\n\x0b\x0c "),
    (4, "one"),
    (5, "Ünï cödé 😀 words"),
    (6, "same text\nsecond line\nthird line of it\nfourth"),
    (7, "same text\nsecond line\nthird line of it\nfourth"),
    (7, "same text\nsecond line\nthird line of it\nfourth"),
    (8, "a\n" * 300),
    (9, LONG),
    (None, "no id here"),
    (None, None),
    (10, "12345 !!! ###"),
]
