"""Plain Python versions of the scores, to check the columns against. Written row by row."""


def edit_distance(a, b, swaps=False):
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
            if swaps and i and j and x == b[j - 1] and a[i - 1] == y:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def lev(a, b):
    if not a or not b:
        return 0.0
    return 1.0 - edit_distance(a.lower(), b.lower()) / max(len(a), len(b))


def jaro_winkler(a, b):
    if not a or not b:
        return 0.0
    a, b = a.lower(), b.lower()
    window = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, first = [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - window), min(len(b), i + window + 1)):
            if not taken[j] and b[j] == x:
                taken[j] = True
                first.append(x)
                break
    second = [y for j, y in enumerate(b) if taken[j]]
    m = len(first)
    if not m:
        return 0.0
    t = sum(x != y for x, y in zip(first, second)) // 2
    jaro = (m / len(a) + m / len(b) + (m - t) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def date_score(a, b):
    if not a or not b:
        return 0.0
    return 1.0 if a == b else 0.8 if a[:7] == b[:7] else 0.5 if a[:4] == b[:4] else 0.0


def score(name_1, date_1, doc_1, code_1, name_2, date_2, doc_2, code_2):
    if doc_1 is None or doc_2 is None:
        return None
    sound = 1.0 if name_1 and name_2 and code_1 == code_2 else 0.0
    return (lev(name_1, name_2) * 0.25 + jaro_winkler(name_1, name_2) * 0.25 + sound * 0.15
            + date_score(date_1, date_2) * 0.25 + (doc_1 == doc_2) * 0.10)
