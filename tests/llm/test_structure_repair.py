import hashlib
import itertools
import random
import re
import zlib

from tests.llm.test_prefix_trie import SCHEMA
from valuemill.llm import structure_repair as sr


def harm(rows):
    out = {}
    for c, turn, role, text in rows:
        own = out.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    digest = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).digest()
    return {c: sorted(own, key=lambda x: (x[0] is not None, x[0] or 0, digest(x[1], x[2]))) for c, own in out.items()}


def cheapest(rows, faults):
    """Least (cost, audit, lines) by states carried forward, every edit tried everywhere."""
    step = {"": "su", "s": "u", "u": "a", "a": "u"}
    now = {"": (0, "", ())}

    def insert(now):
        for _ in range(4):
            for q, (c, x, lines) in list(now.items()):
                for to in set(step[q]) - {"s"}:
                    new = (c + 5, x + "I", (*lines, {"u": "user:", "a": "assistant:"}[to]))
                    now[to] = min(now.get(to, new), new)
        return now

    now = insert(now)
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for q, (c, x, lines) in now.items():
            ways = [(q, (c + 2, x + "D", lines))]
            if fault not in ("blank", "duplicate"):
                c += 5 * (fault == "truncated")
                if role[:1] and role[:1] in step[q]:
                    ways.append((role[0], (c, x + "K", (*lines, f"{role}:{text}"))))
                ways += [(to, (c + 1, x + "R", (*lines, f"{name}:{text}"))) for to, name in (("u", "user"), ("a", "assistant")) if to in step[q]]
            for to, w in ways:
                new[to] = min(new.get(to, w), w)
        now = insert(new)
    return min(now[q] for q in ("", "a") if q in now)


def brute(rows):
    out = {}
    for c, own in harm(rows).items():
        seen, faults = set(), []
        for _, role, text in own:
            faults.append("blank" if not re.search(r"[^\x20\x09-\x0D]", text) else "duplicate" if (role, text) in seen
                          else "truncated" if re.findall(r"[^\x20\x09-\x0D]", text)[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = {t for t, *_ in own} - {None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, lines = cheapest(own, faults)
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def run(df):
    return {r.conv_id: tuple(r)[1:] for r in sr.repair(df, sr.damaged(df)).collect()}


ROLES, TEXTS = ["user", "assistant", "system", "tool", None, "", "unknown"], ["Hi.", "Well!", "no end", "", " \n", None, "a\nb?", "é.  ", "İ", "x. "]


def random_rows(rng, c, n, good=0.0):
    for t in range(n):
        if rng.random() < good:
            yield c, t, ("user", "assistant")[t % 2], f"turn {t}."
        else:
            yield c, rng.choice([t, t, t + 3, None]), rng.choice(ROLES), rng.choice([*TEXTS, f"own {t}."])


def test_against_brute_force(spark):
    rng = random.Random(8)
    rows = [r for c in range(150) for r in random_rows(rng, c, rng.randrange(1, 9), rng.choice([0, 0.5, 0.9]))]
    rows += [(-5, 1, "user", "A."), (None, 2, "assistant", "B."), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert run(df.repartition(3)) == brute(rows)


def test_conversations_of_many_chunks(spark):
    rng = random.Random(9)
    rows = [*random_rows(rng, 1, 5 * sr.CHUNK, 0.97), *random_rows(rng, 2, 3 * sr.CHUNK, 0.2), *[(3, t, "user", f"only {t}.") for t in range(sr.CHUNK + 1)],
            *[(4, 0, "user", "same.")] * (2 * sr.CHUNK), *random_rows(rng, 5, 6, 0.5),
            # one role out of place far from the end: chunks that are in order carry what comes after them
            *[(6, t, ("assistant", "user")[t % 2], f"turn {t}.") for t in range(4 * sr.CHUNK)]]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_fix_up_ends_early_and_agrees():
    rng = random.Random(2)
    for _ in range(300):
        codes = [rng.randrange(16) for _ in range(rng.randrange(1, 60))]
        old, new = ((0, *(rng.randrange(11) for _ in range(3))) for _ in range(2))
        assert sr.fixed_up(codes, old, new, sr.start_costs(codes, old)) == sr.start_costs(codes, new)


def test_empty_table_all_dropped_and_clashing_columns(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(lost, 0, "user", "Gone."), (5, None, "user", "Here."), (5, None, "assistant", "There.")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert run(df) == want and want[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert run(df.selectExpr("*", "1 as conv", "2 as chunk", "'x' as digest", "3 as pos", "4 as cost", "5 as state")) == want
    assert run(df.where("false")) == {}
