"""Small frames with the awkward cases: nulls, empty and long texts, ties, repeated rows, extra columns."""
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, line long, fp string, _source string"
SYLLABLES = "ka lo mi ra te su no vi".split()


def sentence(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows(n=60, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = "\n".join(sentence(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 6)))
        out.append((i, text, "en", f"src{i % 4}" if i % 9 else None, len(text), 7, 3, "x", "y"))
    base = out[5][1]
    out[20] = (20, base, "en", "src1", len(base), 0, 0, None, None)
    out[21] = (21, base + " kalo", "en", "src1", len(base), 0, 0, None, None)
    out[22] = (22, None, None, None, None, None, None, None, None)
    out[23] = (23, "", "", "", 0, 0, 0, "", "")
    out[24] = (24, " \n\t ", "", "src2", 4, 0, 0, "", "")
    out[25] = (25, "Éa KALO\x0bmi\n" + "kalo mi ra te\n" * 40, "fr", "src3", 1, 0, 0, "", "")
    out[26] = (26, sentence(rng, 30000), "en", "src0", 1, 0, 0, "", "")
    out[27] = (None, "kalo mira tesu novi kalomi", None, "src1", None, None, None, None, None)
    out.append(out[30])
    out.append(out[30])
    return out


def docs(spark, n=60, seed=1):
    return spark.createDataFrame(rows(n, seed), SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
