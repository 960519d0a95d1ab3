"""Texts that every operator must take: null, empty, blank, signs, one word."""

ODD = [(900, None), (901, ""), (902, " \t\n\x0b\x0c\r "), (903, "###"), (904, "word"), (None, "a null id is no reason to fail at all"), (905, "é ü 日本 🙂")]
