"""Invented words for fixtures."""


def words(r, n, size=(2, 9)):
    return " ".join("".join(r.choice("abcdefghijklmnoprstuvwz") for _ in range(r.randint(*size))) for _ in range(n))
