import random


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    out = []
    for k in range(words):
        word = "".join(draw.choice("abcdefghiklmnoprstuvwé") for _ in range(draw.randint(1, 8)))
        out.append(word.capitalize() if k % 9 == 0 else word + "." * (k % 9 == 8))
    return " ".join(out)
