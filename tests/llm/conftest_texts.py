"""Documents with odd cases."""

LONG = "alpha beta gamma delta. " * 3000
PASSAGE = " ".join(f"word{i}" for i in range(40))
# nulls, blanks, ties, repeated rows, near and exact copies, a long text, repeated lines, personal data, licences
TEXTS = [
    (0, None), (1, ""), (2, "   \n\t "), (3, "One"), (3, "One"), (4, LONG), (5, LONG + "x"), (6, LONG),
    (7, f"left a {PASSAGE} right b"), (8, f"other {PASSAGE} words"), (9, PASSAGE), (None, "no id here"), (None, None),
    (10, "first line\nsecond line here\nthird one\nfourth\nfifth is long\nsixth\nseventh\neighth"),
    (11, "new top\nfirst line\nsecond line here\nthird one\nfourth\nfifth is long\nsixth\nseventh\neighth"),
    (12, "mail a.b@c.example.org and 10.0.0.255 or 10.0.0.256, card 4111 1111 1111 1111, call +1 (415) 555-0100 now"),
    (13, "Ünïcode before x@y.zz é 1.2.3.4\nReleased under the MIT License."),
    (14, "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction. The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software."),
    (15, "word0 word1 word2 word3 word4 word5 word6 word7 word8 word9 word10 word11 word12 tail"),
    (16, "it's <|endoftext|> Text, with marks!! and ½ ﬁ é."),
]
