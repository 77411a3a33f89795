#: Texts that every operator must stand: NULL, empty, blank, no letter, very long, one endless word.
ODD = [(10100, None), (10101, ""), (10102, " \t\n "), (10103, "123 !? 456"), (10104, "word " * 60_000), (10105, "x" * 100_000),
       (None, "no id here at all"), (10106, "same row"), (10106, "same row"), (10107, "Ünïcödé ▁ 😀   text")]
