"""Scores of one pair at a time, by the table of common subsequences."""


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def ratio(a, b):
    return round(200 * common(a, b) / (len(a) + len(b))) if a or b else 100


def partial_ratio(a, b):
    short, long = sorted((a, b), key=len)
    if not short:
        return 100 if not long else 0
    width = len(short)
    return max(ratio(short, long[i:i + width]) for i in range(len(long) - width + 1))


def token_set(a, b):
    left, right = set(a.split()), set(b.split())
    return 100 if left & right else partial_ratio(" ".join(sorted(left)), " ".join(sorted(right)))
