"""Awkward rows: nulls, empty and very long texts, repeats, clashing names."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size long, kept string, score string, n_words string, component string, u long, v long, _text string, shard int, n string")


def prose(seed, n, words=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


def awkward(unique=True):
    """Rows as ``SCHEMA``; doc_id is unique, or also null and repeated."""
    base = prose(1, 120)
    texts = [
        base, base, base.upper(), "", None, " \n\t ", "one", "one two three four", "one  two\nthree four",
        "a b c d e", base + " tail", prose(2, 60) + "\n" + prose(2, 60), prose(3, 5000), ("x " * 3000).strip(),
        "\n".join(["the same line again"] * 30), prose(1, 40) + " " + prose(4, 80), prose(5, 30) + " " + prose(1, 120)[:400],
        "mail a.b+c@x-y.example.com and 1.2.3.4, 300.1.1.1, card 4111 1111 1111 1111 x, +1 (499) 555-6503.",
        "é ü \U0001F600 ß a@b.co 4111-1111-1111-1111   nbsp", "a@b a@b.c.d@e.f 1.2.3.4.5.6.7.8 +12 +1234567890123456",
        "x" * 30000, "7 " * 4000, "1" * 20000, "@" * 5000, "DE89 3704 0044 0532 0130 00 GB82WEST12345698765432 078-05-1120 ssn",
        "<|endoftext|> It's a İ Σ é test <|startoftext|>", base.replace("w1", "W1"), "tab\tsep\x0bvt\x0cff\rcr",
    ]
    rows = [(i, t, "en" if i % 3 else None, ["a", "b", None, "\U0001F600"][i % 4], i, 9, "k", "s", "n", "c", 1, 2, "t", 3, "m")
            for i, t in enumerate(texts)]
    if not unique:
        rows += [rows[0], rows[0], (None, base, None, None, *rows[0][4:]), (None, None, None, None, *rows[0][4:])]
    return rows
