"""The corpus pipeline against a plain Python version of all five stages."""

import random
import re
import struct
from collections import Counter, defaultdict
from math import exp, log

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from tallyfold.llm import mixing, quality
from tallyfold.llm.queries import SHARES, TOKENIZER
from test_text import brute_components, brute_masked, brute_print, sha

KIND = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the of and to in that is was for with his they this from have word".split(),
         "de": "der die und das ist nicht ein auch sich mit dem werden wird eine auf".split(),
         "fr": "le les des est une dans que pour qui pas plus avec sur sont cette".split(),
         "es": "el los las una que por con para del como pero sus entre sobre muy".split()}


def fixture_rows():
    pick = random.Random(11)
    rows = []
    for k in range(260):
        lang = ["en", "en", "de", "fr", "es"][k % 5]
        words = pick.choices(WORDS[lang], k=pick.randrange(20, 80))
        if k % 3 == 0:
            words = [w.upper() + "##$$" for w in words]  # bad ones
        text = " ".join(words) + "."
        if k % 17 == 0:
            text += f" token={'%016x' % pick.getrandbits(64)} and AKIA{'Z' * 16} end"
        rows.append((k, text, lang, f"s{k % 4}", len(text)))
    rows += [(300 + k, r[1], r[2], "copy", r[4]) for k, r in enumerate(rows[1:20])]  # exact copies
    rows += [(400, None, None, None, None), (401, "", "en", "s", 0), (402, None, "en", "s", 0), (5, rows[5][1], "en", "s", None)]
    return rows


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx(data, seed=42):
    return signed(xxhash.xxh64_intdigest(data, seed % (1 << 64)))


def good(model, text, n_chars):
    """The factorisation machine with every pair written out."""
    rows, buckets, stats = quality.describe([(text or "").encode()])
    _, index, value = model.features(rows, buckets, stats, quality.length_bin([n_chars]))
    margin = model.bias + sum(model.weights[i] * x for i, x in zip(index, value))
    scaled = model.factors[index] * value[:, None]
    margin += sum(float(scaled[a] @ scaled[b]) for a in range(len(index)) for b in range(a))
    return margin >= 0


def one_of_each(docs):
    roots = brute_components([(d[0], brute_print(d[1])) for d in docs])
    return [d for d in docs if d[0] is None or roots[d[0]] == d[0]]


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def bucket(word):
    return xx(word.lower().encode()) % mixing.BUCKETS


def posteriors(docs, texts, labelled, domains):
    tallies, held = {d: Counter() for d in domains}, Counter()
    for doc_id, text, *_ in texts:
        if labelled.get(doc_id) in domains:
            held[labelled[doc_id]] += 1
            tallies[labelled[doc_id]].update(map(bucket, split(text)))
    priors = [log((held[d] + 1) / (sum(held.values()) + len(domains))) for d in domains]
    sums = [sum(tallies[d].values()) + 0.5 * mixing.BUCKETS for d in domains]
    out = []
    for _, text, *_ in docs:
        found = [bucket(w) for w in split(text)]
        scale = min(len(found), mixing.EVIDENCE) / max(len(found), 1)
        scores = [p + scale * sum(log((tallies[d][b] + 0.5) / s) for b in found) for p, d, s in zip(priors, domains, sums)]
        raised = [exp(s - max(scores)) for s in scores]
        out.append((len(found), [e / sum(raised) for e in raised]))
    return out


def rates(table, shares, least):
    width, rate = range(len(shares)), [1.0] * len(table)

    def masses():
        return [sum(r * n * p[k] for r, (n, p) in zip(rate, table)) for k in width]

    start = reached = masses()
    whole = max(start[k] * sum(shares) / shares[k] for k in width)
    target, gaps = [whole * s / sum(shares) for s in shares], []
    while any(abs(a - b) > mixing.TOLERANCE * b for a, b in zip(reached, target)):
        push = [(target[k] - reached[k]) / start[k] for k in width]
        rate = [max(least, r + sum(a * b for a, b in zip(p, push))) for r, (_, p) in zip(rate, table)]
        before, reached = reached, masses()
        if max(abs(a - b) for a, b in zip(before, reached)) <= 1e-9 * whole:
            break
        gaps.append(sum((reached[k] - target[k]) ** 2 / start[k] for k in width))
        if len(gaps) > mixing.PATIENCE and gaps[-1] > (1 - mixing.PROGRESS) * gaps[-1 - mixing.PATIENCE]:
            break
    return rate


def mixed(docs, texts, labelled):
    domains = sorted(SHARES)
    table = posteriors(docs, texts, labelled, domains)
    copies = defaultdict(int)
    for doc, rate in zip(docs, rates(table, [SHARES[d] for d in domains], 1.0)):
        body = 42 if doc[1] is None else xx(doc[1].encode())
        seed = 42 if doc[0] is None else xx(struct.pack("<q", doc[0]))
        chance = xx(struct.pack("<i", 7), xx(struct.pack("<q", body), seed)) % (1 << 30) / (1 << 30)
        copies[doc[0], doc[1]] = max(copies[doc[0], doc[1]], int(rate) + (chance < rate - int(rate)))
    return [d for d in docs for _ in range(copies[d[0], d[1]])]


def digests(docs):
    library = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    for doc_id, text, *_ in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        yield doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_run_is_the_plain_python_version(spark, tmp_path):
    rows = fixture_rows()
    labels = [(k, int(k % 3 != 0), 0) for k in range(0, 260, 2)]
    spark.createDataFrame(rows, KIND).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, told = (spark.read.parquet(f"{tmp_path}/{name}.parquet") for name in ("documents", "labels"))
    model = quality.train(docs, told)
    kept = [r for r in rows if good(model, r[1], r[4])]
    assert len(rows) * 0.4 < len(kept) < len(rows) * 0.9
    kept = one_of_each(kept)
    kept = [(d[0], d[1] if d[1] is None else brute_masked(d[1]), *d[2:]) for d in kept]
    langs = {r[0]: min(x[2] for x in rows if x[0] == r[0]) for r in rows if r[0] in {k for k, *_ in labels}}
    want = sorted(digests(mixed(kept, rows, langs)), key=str)
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=str) == want
    assert len(want) > len(kept)
