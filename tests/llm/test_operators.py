"""The operators against brute force on small tables, with nulls, empty texts, repeated rows and odd columns."""

import hashlib
import random
import re
import string
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomstep.llm import chats, components, embeddings, jaccard, mixing, pii, quality, registry, secrets, tokens, urls

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = r"[^\x20\x09-\x0D]+"


def docs(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)], DOC)


def union_find(ids, pairs):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_components(spark):
    r = random.Random(1)
    pairs = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(None, 3)]
    got = {x["node"]: x["component"] for x in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    assert got == union_find({x for p in real for x in p}, real)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_quality(spark):
    r = random.Random(2)
    texts = [" ".join(r.choice(["a", "b", "c#", "é|", "\n", "\u00a0d"]) for _ in range(r.randint(0, 90))) for _ in range(60)] + [None, "", " \n\t", "w"]
    rules = quality.QualityRules(min_words=5, min_repeat=6, max_repeat=9)
    df = docs(spark, texts).withColumn("n_words", F.lit("clash"))
    got = {x["doc_id"]: x for x in quality.measure(df, rules=rules).withColumn("ok", quality.accepted(rules=rules)).collect()}
    for i, t in enumerate(texts):
        w, q = re.findall(WORDS, t or ""), got[i]["quality"]
        lines = [x for x in (t or "").split("\n") if re.search(WORDS, x)]

        def inside(k):
            grams = Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1))
            return {j + o for j in range(len(w) - k + 1) if grams[tuple(w[j : j + k])] > 1 for o in range(k)}

        longest = max((k for k in range(6, len(w)) if inside(k)), default=0)
        assert (q["n_words"], q["word_chars"]) == (len(w), sum(map(len, w)))
        assert q["n_symbols"] == sum((t or "").count(c) for c in "#*$%&|<>") and q["n_dup_lines"] == len(lines) - len(set(lines))
        assert (q["n_repeat_words"], q["covered_words"], q["longest_repeat"]) == (len(inside(3)), len(inside(6)), longest)
        ok = len(w) >= 5 and 2 * len(inside(3)) <= len(w) and len(inside(6)) <= 0.3 * len(w) and longest <= 9
        assert got[i]["ok"] == ok and got[i]["n_words"] == "clash"


def test_pii(spark):
    anchors = pii.automaton()
    plain = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]

    def fine(kind, s):
        digits = re.findall("[0-9]", s)
        if kind == "ip":
            return all(int(x) <= 255 for x in s.split("."))
        if kind == "card":
            double = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
            return 13 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in double) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    r = random.Random(3)
    for k in range(6000):
        letters = ["a@.-1 ", "123.4. ", "0123456789 -", "+1 ().-23", "ab@.1+é", "1.2.3.4@a.b"][k % 6]
        t = "".join(r.choice(letters) for _ in range(r.randint(0, 60)))
        base = [(kind, *m.span()) for kind, p in plain for m in re.finditer(p, t) if fine(kind, m[0])]
        assert [x for x in pii.find(t, anchors) if x[0] in pii.BASE] == base, t
    assert ("iban", 6, 28) in pii.find("IBAN: DE89370400440532013000.", anchors)
    assert pii.pii_spans(docs(spark, [])).count() == 0
    twice = docs(spark, ["x@y.zz"]).union(docs(spark, ["x@y.zz"]))
    assert [len(x["pii"]) for x in pii.pii_spans(twice).collect()] == [1, 1]
    assert ("login", 8, 15) in pii.find("https://ann:pw1@x.org/", anchors)
    out = pii.pii_spans(docs(spark, ["é x@y.zz", None, ""]).withColumn("kind", F.lit(1))).collect()
    assert [[tuple(s) for s in r["pii"]] for r in sorted(out)] == [[("email", 2, 8)], [], []]


def test_pii_boundaries_of_accounts():
    anchors = pii.automaton()
    own = lambda t: [(k, t[a:b]) for k, a, b in pii.find(t, anchors) if k in ("account", "iban")]
    number = [("account", "12345678")]
    assert own("Account: 12345678 PLEASE PAY NOW") == own("Customer No: 12345678") == own("Kontonummer: 12345678") == own("account number is 12345678") == number
    assert own("IBAN DE89370400440532013000 BIC COBADEFF") == own("see DE89370400440532013000.") == [("iban", "DE89370400440532013000")]
    assert own("IBAN: DE89 3704 0044 0532 0130 00 PAY") == [("iban", "DE89 3704 0044 0532 0130 00")]
    for t in ("my account is fine 2024", "accounting 12345678", "XDE89370400440532013000", "DE88370400440532013000", "account holder 2019", "DE8937040044053201300", "DE893704004405320130001"):
        assert own(t) == [], t
    r = random.Random(16)
    for _ in range(200):
        country = r.choice(sorted(pii.IBAN_LENGTHS))
        rest = "".join(r.choice(string.digits if r.random() < 0.8 else string.ascii_uppercase) for _ in range(pii.IBAN_LENGTHS[country] - 4))
        check = 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97
        iban = f"{country}{check:02d}{rest}"
        if r.random() < 0.5:
            iban = " ".join(iban[i : i + 4] for i in range(0, len(iban), 4))
        account = "".join(r.choice(string.digits) for _ in range(r.randint(6, 12)))
        account = r.choice([account, account[:3] + "-" + account[3:], "KX" + account, account[:4] + " " + account[4:]])
        cue = r.choice([x for cue in ("account", "konto", "passport", "customer no", "client id") for x in (cue, cue.title(), cue.upper())]) + r.choice([": ", " ", "# ", " = "])
        before, behind = r.choice(["", "see ", "(", "ÄÖ, "]), r.choice(["", ".", " PLEASE", ", then", ") x", " and BIC"])
        assert own(f"{before}{cue}{account}{behind}") == [("account", account)], (cue, account, behind)
        assert ("iban", iban) in own(f"{before}{iban}{behind}"), (before, iban, behind)


def test_tokens(spark):
    scores = {"▁": -3.0, "a": -1.0, "b": -1.0, "ab": -2.0, "aab": -2.5, "▁ba": -1.5, "é": -2.0}
    byte = min(scores.values()) - 1

    def best(word):
        found = [(0.0, 0)]
        for i in range(1, len(word) + 1):
            size = len(word[i - 1].encode())
            options = [(found[i - 1][0] + size * byte, found[i - 1][1] - size)]
            options += [(found[j][0] + scores[word[j:i]], found[j][1] - 1) for j in range(i) if word[j:i] in scores]
            found.append(max(options))
        return -found[-1][1]

    r = random.Random(4)
    texts = [" ".join("".join(r.choice("abcé") for _ in range(r.randint(0, 9))) for _ in range(30)) for _ in range(20)] + [None, "", "ab" * 3000]
    got = {x["doc_id"]: (x["n_pretokens"], x["n_tokens"]) for x in tokens.count_tokens(docs(spark, texts), scores).collect()}
    assert got == {i: (len(re.findall(WORDS, t or "")), sum(best("▁" + w) for w in re.findall(WORDS, t or ""))) for i, t in enumerate(texts)}
    assert tokens.count_tokens(docs(spark, []), scores).count() == 0
    twice = docs(spark, ["ab"]).union(docs(spark, ["ab"])).withColumn("n_tokens", F.lit("clash"))
    assert [x["n_tokens"] for x in tokens.count_tokens(twice, scores).collect()] == [best("▁ab")] * 2


def test_tokens_of_a_huge_word():
    """A word of a million characters, alone in its batch, and shorter ones by both ways."""
    r, scores = random.Random(17), {"▁": -3.0, "a": -1.0, "b": -1.5, "ab": -2.0, "bba": -2.25, "é": -2.0}
    vocabulary = tokens.Vocabulary(scores)
    words = sorted({"▁" + "".join(r.choice("abcé") for _ in range(r.randint(1, 40))) for _ in range(300)})
    assert [tokens.long_count(w, vocabulary) for w in words] == tokens.trie_counts(words, vocabulary).tolist()
    assert tokens.trie_counts(["▁" + "ab" * 500_000, "▁é"], vocabulary).tolist() == [500_001, 2]


def test_scores_are_fitted_on_all_documents(spark):
    """Scores against counts of the model's own split, taken word by word."""
    import sentencepiece

    path = registry.tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [None, "", "the cat the cat sat", "thermal\tdynamics  é日 the"]
    times = Counter(i for t in texts for w in re.findall(WORDS, t or "") for i in model.encode(w))
    got = tokens.fit_scores(docs(spark, texts), path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    total = sum(times[i] + 0.5 for i in ids)
    assert got.keys() == {model.id_to_piece(i) for i in ids}
    assert all(got[model.id_to_piece(i)] == pytest.approx(np.log((times[i] + 0.5) / total)) for i in ids)


@pytest.mark.parametrize(("width", "threshold"), [(3, Fraction(9, 10)), (5, Fraction(4, 5))])
def test_jaccard(spark, width, threshold):
    r = random.Random(5)
    base = [[r.choice("abcdefghijklmnopqrstuvwxyz") + r.choice("xyz") for _ in range(n)] for n in (0, 1, 2, 4, 30, 60, 60, 200)]
    texts = [None, "", " \t"]
    for w in base:
        for _ in range(12):
            copy = list(w)
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                if copy:
                    copy[r.randrange(len(copy))] = "new" + str(r.randint(0, 9))
            texts.append(" ".join(copy).upper() if r.random() < 0.2 else " ".join(copy))
    df = docs(spark, texts).withColumn("n", F.lit("clash"))
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard.similar_documents(df.union(df.limit(20)), width=width, threshold=threshold).collect()}
    sets = []
    for t in texts:
        w = re.findall(WORDS, (t or "").lower())
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    close = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and len(sets[i] & sets[j]) * threshold.denominator >= threshold.numerator * len(sets[i] | sets[j])]
    component = union_find(range(len(sets)), close)
    assert got == {i: (len(s), component[i]) for i, s in enumerate(sets)}
    assert jaccard.similar_documents(docs(spark, [])).count() == 0


def test_jaccard_of_a_group_in_several_components(spark):
    """Two classes of one group (same prefix and size) that link only through a set of another group."""
    name = lambda kind, n: [f"{kind}{i}" for i in range(n)]
    rare, common, tails = name("u", 64), name("p", 30), [name("a", 15), name("b", 15)]
    texts = [rare + common + tails[0], rare + common + tails[1], rare + common]
    texts += [name(f"x{i}y", 200) + rare[-4:] + common + tails[i % 2] for i in range(20)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    close = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j])]
    assert close == [(2, 0), (2, 1)]
    for order in (range(len(texts)), [2, 0, 1, *range(3, len(texts))], [1, 2, 0, *range(3, len(texts))]):
        df = docs(spark, [" ".join(texts[i]) for i in order])
        got = {x["doc_id"]: x["component_id"] for x in jaccard.similar_documents(df).collect()}
        assert got == {i: 0 if order[i] in (0, 1, 2) else i for i in range(len(texts))}


def test_embeddings(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 24))
    x[300:600] = x[:300] + rng.normal(size=(300, 24)) * 0.2
    x[600:700] = x[5]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(1000, None), (1001, [0.0] * 24), (1002, [None] + [1.0] * 23), (1003, [float("nan")] + [1.0] * 23), (1004, [1e300] * 24), (1005, [2e-300] * 24), (1006, [])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("cell", F.lit("clash"))
    got = {r["vec_id"]: r for r in embeddings.near_vectors(df).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    want = near.sum(1) - 1
    found = np.array([got[i]["n_links"] for i in range(900)])
    assert (found <= want).all() and found.sum() >= 0.99 * want.sum()
    assert [got[i]["n_links"] for i in range(1000, 1007)] == [0, 0, 0, 0, 1, 1, 0]
    assert got[1005]["component_id"] == 1004 and all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert got[650]["component_id"] == 5
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_embeddings_of_many_cells(spark):
    """Cells that outnumber those asked by ten: recall against brute force, with pairs right above and below the limit."""
    rng = np.random.default_rng(18)
    d, unit = 48, lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    topic = unit(rng.normal(size=(120, d)))
    x = unit(np.repeat(topic, 20, axis=0) + unit(rng.normal(size=(2400, d))) * 0.7)
    cosine = rng.uniform(0.88, 0.95, size=1200)
    side = rng.normal(size=(1200, d))
    side = unit(side - (side * x[:1200]).sum(1, keepdims=True) * x[:1200])
    x = np.concatenate([x, cosine[:, None] * x[:1200] + np.sqrt(1 - cosine**2)[:, None] * side])
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_vectors(df, per_cell=30).collect()}
    near = x @ x.T
    want = (near >= 0.9).sum(1) - 1
    found = np.array([got[i] for i in range(len(x))])
    cells = embeddings.n_cells(len(x), 30)
    print(f"{cells} cells, recall {found.sum() / want.sum():.4f} of {want.sum()} links")
    assert cells >= 100 and (found <= want).all() and want.sum() > 1000 and found.sum() >= 0.99 * want.sum()
    exact = {r["vec_id"]: r["n_links"] for r in embeddings.near_vectors(df, per_cell=300, margin=99.0).collect()}
    assert [exact[i] for i in range(len(x))] == want.tolist()


def test_centres_against_one_process(spark, monkeypatch):
    """Rounds in tasks give what they give in one process, from a sample that the hash takes."""
    monkeypatch.setattr(embeddings, "SAMPLE", 500)
    rng = np.random.default_rng(28)
    x = np.repeat(rng.normal(size=(40, 12)), 40, axis=0) + rng.normal(size=(1600, 12)) * 0.3
    df = spark.createDataFrame([(v.tolist(),) for v in x] + [([1.0, 2.0],)], "v array<double>").repartition(5)
    got = embeddings._centres(df, 40, 3)
    rows = sorted((r["h"], r["v"]) for r in df.where(F.size("v") == 12).select("v", F.xxhash64("v", F.lit(3)).alias("h")).collect())
    kept = np.array([v for h, v in rows if h <= embeddings._below(1600, 500)])
    kept /= np.linalg.norm(kept, axis=1, keepdims=True)
    assert 400 < len(kept) < 600 and embeddings._below(7, 7) == embeddings._below(7, 99) == 2**63 - 1
    want = kept[:40]
    for _ in range(embeddings.ROUNDS):
        cell = (kept @ want.T).argmax(1)
        want = np.stack([s / np.linalg.norm(s) if (s := kept[cell == i].sum(0)).any() else want[i] for i in range(40)])
    assert np.allclose(got[12], want) and np.allclose(got[2], np.array([[1, 2]]) / 5**0.5)


def test_secrets(spark):
    r = random.Random(7)
    key = lambda n: "".join(r.choice("abcdef0123456789") for _ in range(n))
    texts = [None, "", f"Token = '{key(40)}' é password:short", f"é {key(31)} {key(33)}", "AKIA" + "Q" * 12 + " AKIAX", f"token=token:{key(20)}", "a plain_identifier_with_words here", "see xK9pQ2vLw8Zr4TnB7yHc3MfJd6SgAe1uKo5X now"]
    texts += [" ".join(r.choice(["the", "re", "tion", "in", "an", "er"]) + "".join(r.choice(["and", "ing", "ly", "est", "on", "_id"]) for _ in range(3)) for _ in range(400)) for _ in range(8)]
    patterns = [("assign", secrets.ASSIGN), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]+")]
    fine = {"assign": lambda m: len(m[2]) >= 8, "access": lambda m: len(m[0]) >= 16, "hex": lambda m: len(m[0]) >= 32}
    df = docs(spark, texts).withColumn("kind", F.lit(1))
    got = {x["doc_id"]: [(secrets.KINDS[s["kind"]], s["start"], s["end"]) for s in x["secrets"]] for x in secrets.secret_spans(df).collect()}
    for i, t in enumerate(texts):
        base = sorted(((m.start(), k, name, m.end()) for k, (name, p) in enumerate(patterns) for m in re.finditer(p, t or "") if fine[name](m)))
        assert [s for s in got[i] if s[0] != "random"] == [(name, a, b) for a, _, name, b in base]
    assert [s[0] for s in got[7]] == ["random"] and got[6] == []
    clean = {x["doc_id"]: x["text"] for x in secrets.redact(df).collect()}
    assert clean[0] is None and clean[6] == texts[6] and clean[7] == "see [SECRET] now" and "[SECRET]' é password:short" in clean[2]


def test_secrets_on_labelled_strings(spark):
    """Strings that the model's own samples are not made of: random ones of 20 characters and more are found, identifiers are not."""
    r = random.Random(13)
    letters, digits = string.ascii_letters, string.digits
    alphabets = (letters + digits, letters, "0123456789abcdef", string.ascii_uppercase + digits, string.ascii_lowercase + digits, letters + digits + "+/", letters + digits + "-_")
    keys = ["".join(r.choice(x) for _ in range(n)) for n in (20, 24, 32, 40) for x in alphabets for _ in range(25)]
    plain = """user_account_id_2024_01_15 getUserAccountById2024Handler /usr/local/lib/python3/site-packages iso-8859-1-windows-1252-utf8
      test_integration_case_0000000123 00000000000000000000 http2_server_connection_pool ---------------------- 2024-01-15T10-30-45-000Z
      v1-2-3-beta-4-release Donaudampfschifffahrtsgesellschaft AbstractSingletonProxyFactoryBean org/apache/spark/sql/catalyst/plans
      com-example-myapp-production-01 MAX_CONNECTION_TIMEOUT_SECONDS_30 IMG_20240115_103045_HDR abcdefghijklmnopqrstuvwxyz
      0123456789012345678901234567 text-embedding-ada-002-v2 my-bucket/logs/2024/01/15/part-00000 antidisestablishmentarianism
      incomprehensibilities_and_more chrome_87_windows_nt_10_0_win64_x64 sha256_checksum_of_the_file_v2 libstdc++-6-dev-amd64-cross
      self_attention_layer_12_head_8_weight ============================== std__vector_int_allocator_int onActivityResultReceiver42
      report_q3_2023_final_v2_reviewed ISBN-978-3-16-148410-0 +1-800-555-0199-0000 utf8_general_ci_utf8mb4_unicode
      Win32_OperatingSystem_LastBootUpTime kubernetes-dashboard-csrf-cookie thequickbrownfoxjumpsoverthelazydog""".split()
    nouns = "invoice customer payment ledger shipment warehouse refund tariff voucher receipt supplier region".split()
    for i in range(120):
        a, b, c = r.sample(nouns, 3)
        n = r.randint(0, 9999)
        plain.append((f"{a}_{b}_{c}_{n:06d}", f"{a}{b.title()}{c.title()}Of{n}", f"/srv/{a}/{b}-{n}/{c}_{n}", f"20{n % 100:02d}-0{n % 9 + 1}-1{n % 10}-{a}-{b}", f"{a.upper()}_{b.upper()}_{n}_{c.upper()}")[i % 5])
    texts = keys + plain
    model = secrets.train(docs(spark, ["the cat sat on the mat"]).select(secrets.base_spans(F.col("text")).alias("spans")), docs(spark, ["the cat sat"]), "text")
    found = {x["doc_id"]: len(x["secrets"]) for x in secrets.secret_spans(docs(spark, [f"see {t} now" for t in texts]), model=model).select("doc_id", "secrets").collect()}
    hits = [found[i] > 0 for i in range(len(texts))]
    recall, false = sum(hits[: len(keys)]) / len(keys), sum(hits[len(keys) :]) / len(plain)
    print(f"recall {recall:.3f} of {len(keys)}, false positives {false:.3f} of {len(plain)}")
    assert recall >= 0.95 and false < 0.02
    assert secrets.secret_spans(docs(spark, []), model=model).count() == 0
    twice = docs(spark, [f"x {keys[0]}"]).union(docs(spark, [f"x {keys[0]}"]))
    assert [len(x["secrets"]) for x in secrets.secret_spans(twice, model=model).collect()] == [1, 1]


def test_secrets_of_a_text_with_many(spark):
    """Places and redaction of thousands of hits, each pattern beside tokens of the model's."""
    r = random.Random(14)
    random_token = lambda: "".join(r.choice(string.ascii_letters + string.digits) for _ in range(28))
    words = [r.choice([f"token=abcdefgh{i}", f"é{i}", "AKIA" + "Q1" * 8, random_token(), f"password: {random_token()}/AKIA{'7' * 14}"]) for i in range(4000)]
    text = " ".join(words)
    got = secrets.secret_spans(docs(spark, [text])).first()["secrets"]
    base = sorted([(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text) if len(m[2]) >= 8] + [(m.start(), 1, m.end()) for m in re.finditer(secrets.ACCESS, text) if len(m[0]) >= 16])
    assert [tuple(s) for s in got if s["kind"] < 3] == base
    own = [tuple(s) for s in got if s["kind"] == 3]
    assert own and not any(a < e and s < b for s, _, e in base for a, _, b in own)
    at, want = 0, ""
    for s, _, e in map(tuple, got):
        if s >= at:
            want += text[at:s] + "[SECRET]"
        at = max(at, e)
    assert secrets.redact(docs(spark, [text])).first()["text"] == want + text[at:]


def test_urls(spark):
    rows = [(i, u) for i, u in enumerate([None, "", "no scheme", "HTTP://A.EXAMPLE.NET/en/x?q#f", "http://example.net/de/", "https://x.org/fr/a", "https://x.org?y", "http://notexample.com/de/1", "a://b://c/d"])]
    rows += [(100 + i, f"https://good{i}.org/fr/page{i}.html") for i in range(300)] + [(1000 + i, f"http://bad{i}.net/en/buy-{i}?spam={i}") for i in range(300)]
    rows += [(2000, "https://good9.info/fr/page77.html"), (2001, "http://bad7.info/en/buy-3?spam=7")]
    df = spark.createDataFrame(rows + rows[:3], "page_id long, url string").withColumn("score", F.lit(1))
    out = {r["page_id"]: r for r in urls.judge(df).collect()}
    seen = [(out[i]["host"], out[i]["path"], out[i]["rule"]) for i in range(9)]
    assert seen == [("", "", None)] * 3 + [("a.example.net", "/en/x", "example.net/en/"), ("example.net", "/de/", "net/"), ("x.org", "/fr/a", "org/fr/"), ("x.org", "", None), ("notexample.com", "/de/1", None), ("b:", "//c/d", None)]
    assert (out[2000]["verdict"], out[2001]["verdict"], out[3]["verdict"], out[4]["verdict"]) == ("allow", "block", "allow", "block")
    assert urls.judge(df).count() == len(rows) + 3 and urls.judge(df.limit(0)).count() == 0
    one = urls.judge(df.where("url like '%good%'")).select("verdict").distinct().collect()
    assert [x["verdict"] for x in one] == ["allow"]  # no label of the other kind


def test_urls_where_no_rule_decides(spark):
    """The models judge by the rest of a URL: hosts that share a rule's domain but deserve the other verdict get it."""
    r = random.Random(15)
    fine, junk = "guide recipe lesson history garden museum letter review".split(), "casino jackpot viagra pills winner bonus slots cheap".split()
    slug = lambda words: "-".join(r.sample(words, 2)) + f"-{r.randint(1, 9999)}"
    rows = [(f"http://{r.choice('abc')}.example.{'org/fr' if k else 'com/de'}/{slug(fine if k else junk)}.html", None) for k in (0, 1) for _ in range(400)]
    rows += [(f"http://{r.choice('xyz')}.example.{place}/{slug(fine if k else junk)}.html", k) for place in ("org/de", "com/en", "com/fr", "edu/es") for k in (0, 1) for _ in range(40)]
    got = urls.judge(spark.createDataFrame(rows, "url string, want int")).where("want is not null").collect()
    wrong = sum((x["verdict"] == "allow") != bool(x["want"]) for x in got)
    print(f"{wrong} of {len(got)} urls that no rule decides judged wrong")
    assert all(x["rule"] is None for x in got) and wrong <= 0.05 * len(got)
    given = [("http://a.b.Example.net/en/x/y?q#f", "example.net/en/"), ("https://x.net", "net/"), ("http://net/y", "net/"), ("net/x", None), ("a://net/en", None), (None, None), ("a://b.org/fr/?x/y", "org/fr/")]
    cut = spark.createDataFrame([(i, *g) for i, g in enumerate(given)], "i int, u string, rule string").select("i", urls.unruled(F.col("u"), *urls.host_and_path(F.col("u")), F.col("rule")).alias("u"))
    assert [x["u"] for x in cut.orderBy("i").collect()] == ["http://a.b.x/y?q#f", "https://x.", "http://y", "net/x", "a://net/en", "", "a://b.?x/y"]


def test_urls_are_read_whole(spark):
    """Hosts of two labels and a path of one segment have scores of their own, and columns named like temporary ones stay."""
    parts = ["http://casino-jackpot.com/casino-jackpot", "http://history-museum.com/history-museum", "http://xxx.com/xxx", "http://library.com/library"]
    rows = [(u, "mine") for u in parts] + [(f"http://{w}{i}.org/fr/{w}-{i}", "mine") for i in range(60) for w in ("library", "museum", "history")]
    rows += [(f"http://{w}{i}.net/{w}-{i}", "mine") for i in range(60) for w in ("casino", "jackpot", "xxx")]
    df = spark.createDataFrame(rows, "url string, _url string").select("*", *(F.col("_url").alias(c) for c in ("_rule", "_t", "_y")))
    out = urls.judge(df)
    assert out.columns == [*df.columns, "host", "path", "rule", "score", "verdict"]
    got = {r["url"]: r for r in out.collect()}
    assert len({round(got[u]["score"], 9) for u in parts}) == 4 and all(set(r[1:5]) == {"mine"} for r in got.values())
    assert [got[u]["verdict"] for u in parts] == ["block", "allow", "block", "allow"]


def test_chats(spark):
    rows = [("t", 1, None, 1.0, "user", "hi <s> <\\s> ~1"), ("t", 2, 1, 2.0, "assistant", "[INST] ok [/INST]<|im_end|>\n"), ("t", 3, 1, 5.0, "assistant", "no"), ("t", 4, 3, None, "a\n~b", None), ("u", 9, 7, 1.0, None, ""), ("c", 1, 2, 1.0, "x", "y"), ("c", 2, 1, 1.0, "x", "y")]
    m = spark.createDataFrame(rows + rows[:1], "tree string, node long, parent long, score double, role string, text string").withColumn("depth", F.lit("clash"))
    done = chats.format_chats(m)
    back = done.select("tree", "leaf", "score", chats.read_turns(F.col("formatted")).alias("turns"), chats.masked(F.col("formatted"), F.col("loss")).alias("loss"), "formatted").collect()
    got = {(r["tree"], r["leaf"]): (r["score"], [tuple(t) for t in r["turns"]], r["loss"]) for r in back}
    text = {(r[0], r[1]): (r[4] or "", r[5] or "") for r in rows}
    assert got == {
        ("t", 2): (3.0, [text["t", 1], text["t", 2]], text["t", 2][1]),
        ("t", 4): (6.0, [text["t", 1], text["t", 3], text["t", 4]], "no"),
        ("u", 9): (1.0, [text["u", 9]], ""),
    }
    assert [r["leaf"] for r in chats.format_chats(m, best=1).where("tree = 't'").collect()] == [4]
    assert chats.format_chats(m.limit(0)).count() == 0


def test_chats_of_many_turns(spark):
    """A chain of thousands of turns: places of the loss mask, and its texts."""
    n = 3000
    said = lambda i: ("user", f"q{i} é</s>") if i % 2 else ("assistant", f"[INST]{i}" * (i % 3))
    rows = [("t", i, i - 1 if i else None, 0.0, *said(i)) for i in range(n)]
    done = chats.format_chats(spark.createDataFrame(rows, "tree string, node long, parent long, score double, role string, text string"))
    r = done.withColumn("turns", chats.read_turns(F.col("formatted"))).withColumn("own", chats.masked(F.col("formatted"), F.col("loss"))).first()
    assert [tuple(t) for t in r["turns"]] == [said(i) for i in range(n)] and r["n_turns"] == n
    assert r["own"] == "".join(said(i)[1] for i in range(n) if i % 2 == 0) and len(r["loss"]) == n // 2


def test_chats_of_a_null_tree(spark):
    rows = [(None, 1, None, 1.0, "user", "a"), (None, 2, 1, 1.0, "assistant", "b"), (None, None, 1, 1.0, "user", "c")]
    out = chats.format_chats(spark.createDataFrame(rows, "tree long, node long, parent long, score double, role string, text string"), best=1).collect()
    assert [(r["tree"], r["leaf"], r["n_turns"]) for r in out] == [(None, 2, 2)]


def test_mixing(spark):
    r = random.Random(8)
    rows = [(i, "w " * r.randint(0, 60), r.choice(["a", "a", "a", "b", "é", None]), "clash") for i in range(1500)] + [(None, None, "b", "x"), (3, "w w", "z", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mix(df).collect()
    sizes = Counter()
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, left, target = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in target]
        rate = left / sum(weight[s] for s in rest)
        full = [s for s in rest if 2 * sizes[s] <= rate * weight[s]]
        if not full:
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
    target |= {s: rate * weight[s] for s in rest}
    taken = Counter()
    for x in got:
        assert x["target"] == pytest.approx(target[x["source"]]) and x["source_size"] == sizes[x["source"]] and 0 <= x["taken"] <= 2 * x["size"]
        taken[x["source"]] += x["taken"]
    assert all(abs(taken[s] - target[s]) <= 24 for s in order) and len(got) == len(rows)
    assert sorted(map(str, mixing.mix(df.repartition(3)).collect())) == sorted(map(str, got))
    assert mixing.mix(df.limit(0)).count() == 0


def test_sainte_lague(spark):
    r = random.Random(9)
    for _ in range(3):
        votes, seats = [r.choice([0, 1, 5, 7, 100, r.randint(0, 1000)]) for _ in range(9)], r.randint(0, 300)
        held = [0] * 9
        for _ in range(seats if sum(votes) else 0):
            held[max(range(9), key=lambda i: (votes[i] / (2 * held[i] + 1), -i))] += 1
        units = spark.createDataFrame([(0, i, v) for i, v in enumerate(votes)], "g int, i int, v long")
        for group in (["g"], []):
            got = mixing.sainte_lague(units, group, "v", F.lit(seats), [F.col("i")], "q").orderBy("i").collect()
            assert [x["q"] for x in got] == held


def test_sums_before_in_many_ranges(spark):
    rows = [(random.Random(i).randint(-40, 40), i) for i in range(700)] + [(None, 700)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = mixing.in_order(spark.createDataFrame(rows, "k int, i int"), [F.col("k").desc_nulls_last(), F.col("i")], {"rank": F.lit(1), "total": F.col("i")})
        assert mixing.in_order(spark.createDataFrame([], "k int"), [F.col("k")], {"rank": F.lit(1)}).count() == 0
        total = 0
        for place, (x, (k, i)) in enumerate(zip(got.orderBy("rank").collect(), sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1])), strict=True)):
            assert tuple(x) == (k, i, place, total)
            total += i
        assert len(set(got.inputFiles())) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def small_tables(spark, path, empty=False):
    """Tables with nulls, empty and repeated rows and columns that are named like those of the results."""
    r = random.Random(19)
    long = " ".join(r.choice("abcdefgh") + r.choice("xyz") for _ in range(9000))
    texts = [None, "", " \n\t", long, long, "token = abcdefgh12 ann@x.org 10.0.0.1 +49 30 1234567", "AKIA" + "Q" * 16 + " 4111 1111 1111 1111", "é " * 70, long + " end"]
    rows = [(i, t, "en", r.choice(["a", "b", None]), len(t or ""), "x", "y", 7) for i, t in enumerate(texts)]
    rows += [rows[5], (None, "a null id", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    frame = spark.createDataFrame(rows, f"{DOC}, spans string, kept string, size int")
    (frame.limit(0) if empty else frame).write.parquet(f"{path}/documents.parquet")
    x = [[1.0, 0.0], [1.0, 0.1], [0.0, 1.0], None, [0.0, 0.0], [None, 1.0]]
    frame = spark.createDataFrame([*((i, v, 1, 5) for i, v in enumerate(x)), (1, [1.0, 0.1], 1, 5), (None, [1.0, 0.0], 1, 5)], "vec_id long, embedding array<double>, label int, n_links int")
    (frame.limit(0) if empty else frame).write.parquet(f"{path}/embeddings.parquet")
    urls_ = [None, "", "x", "http://a.net/en/", "https://b.example.com/de/1?q", "http://c.org/fr/", "http://d.com/", "http://c.org/fr/"]
    frame = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls_)], "page_id long, url string, host string, verdict string")
    (frame.limit(0) if empty else frame).write.parquet(f"{path}/pages.parquet")
    frame = spark.createDataFrame([(1, 0, "user", "hi", 0), (1, 1, "assistant", None, 0), (None, 0, None, "x", 0)], "conv_id long, turn long, role string, text string, loss int")
    (frame.limit(0) if empty else frame).write.parquet(f"{path}/conversations.parquet")
    return texts


def test_registered_queries_on_odd_tables(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = small_tables(spark, tmp_path)
    got = {name: run(spark, str(tmp_path)) for name, run in registry.queries().items()}
    rows = {name: [x.asDict() for x in df.collect()] for name, df in got.items()}
    by = lambda name, key="doc_id": {x[key]: x for x in rows[name]}
    assert {name: len(x) for name, x in rows.items() if name not in ("op5_ngram_jaccard", "op9_best_fit_packing")} == {
        "op1_chat_format": 3, "op2_secret_scan": 12, "op3_near_vectors": 8, "op4_quality_rules": 12, "op6_token_counts": 12, "op7_pii": 12, "op8_source_mix": 12, "op10_url_filter": 8,
        "op11_class_lm": 12, "op12_token_alignment": 12, "op13_merkle_manifest": 12,
    }
    digest = lambda spans: hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    assert by("op2_secret_scan")[5]["base_sha256"] == digest([("assign", 0, 18)]) and by("op2_secret_scan")[6]["n_access"] == 1 and by("op2_secret_scan")[0]["base_sha256"] == digest([])
    assert by("op7_pii")[5]["spans"] == "email:19:28,ip:29:37,phone:38:52" and by("op7_pii")[6]["n_card"] == 1
    assert dict(got["op7_pii"].dtypes) == {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"}
    links = {(x["vec_id"], x["n_links"], x["component_id"], x["kept"]) for x in rows["op3_near_vectors"]}
    assert links == {(0, 2, 0, True), (1, 2, 0, False), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (None, 0, None, True)}
    near = [(x["doc_id"], x["n_shingles"], x["component_id"]) for x in rows["op5_ngram_jaccard"]]
    sizes = [len({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))}) if w else 0 for w in (re.findall(WORDS, (t or "").lower()) for t in texts)]
    assert sorted(near, key=str) == sorted([*((i, sizes[i], 3 if i in (3, 4, 8) else i) for i in range(9)), (None, 1, None), (None, 0, None)], key=str)
    assert by("op6_token_counts")[2]["n_tokens"] == 0 and by("op6_token_counts")[5]["n_pretokens"] == len(re.findall(WORDS, texts[5]))
    for x in rows["op8_source_mix"]:
        assert 0 <= x["taken"] <= 2 * x["size"] and x["target"] <= 2 * x["source_size"]
    assert set(got["op8_source_mix"].columns) >= {"doc_id", "size", "source_size", "target", "taken"}
    tok, pieces = Tokenizer.from_file(registry.tokenizer_path("word_bpe_49k.json")), Counter(x["doc_id"] for x in rows["op9_best_fit_packing"])
    for i in (0, 3, 7):
        n = len(tok.encode(texts[i] or "", add_special_tokens=False).ids) + 1
        assert pieces[i] == -(-n // 4096) and sum(x["length"] for x in rows["op9_best_fit_packing"] if x["doc_id"] == i) == n
    seen = {x["page_id"]: (x["host"], x["path"], x["rule"]) for x in rows["op10_url_filter"]}
    assert seen[0] == ("", "", None) and seen[3] == ("a.net", "/en/", "net/") and seen[5] == seen[7] == ("c.org", "/fr/", "org/fr/") and seen[6] == ("d.com", "/", None)


def test_registered_queries_on_empty_tables(spark, tmp_path):
    small_tables(spark, tmp_path, empty=True)
    for name, run in registry.queries().items():
        assert run(spark, str(tmp_path)).count() == (1 if name == "op1_chat_format" else 0), name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Columns that are named like the stages' own results stay as they are, equal rows count once in the join."""
    small_tables(spark, tmp_path)
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    made = corpus_pipeline.quality_rules(spark, frame, str(tmp_path))
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == made.columns and {x["spans"] for x in frame.collect()} <= {"x", None}, name
    assert {x["doc_id"] for x in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= {3, 4, 7, 8}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.queries()[name](spark, SF)
    rel = con.sql(registry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert sorted(str(tuple(r[c] for c in columns)) for r in got.collect()) == sorted(str(tuple(r[i] for i in at)) for r in rel.fetchall())


def test_pipeline(spark, tmp_path):
    r = random.Random(10)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    texts = [" ".join(r.choice(vocabulary) for _ in range(80)) for _ in range(40)]
    secret = hashlib.sha1(b"x").hexdigest()
    texts += [texts[0], texts[1] + " end", "too short", " ".join([texts[2]] * 3), None, " ".join(r.choice(vocabulary) for _ in range(60)) + f' token = "{secret}"']
    docs(spark, texts).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3)).write.parquet(str(tmp_path / "documents.parquet"))
    frame, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == frame.columns
        out.write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        seen.append(sorted(x["doc_id"] for x in frame.collect()))
    assert seen[0] == [*range(42), 45] and seen[1] == [*range(40), 45] and seen[2] == seen[1] and set(seen[3]) <= set(seen[2])
    assert secret not in "".join(x["text"] for x in spark.read.parquet(str(tmp_path / "secret_scan")).collect())
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(x["doc_id"] for x in whole if x["piece"] == 0) == Counter(seen[3])


def test_pipeline_mixes_rows_without_id(spark):
    df = docs(spark, ["w " * 20] * 6).withColumn("doc_id", F.when(F.col("doc_id") < 4, F.col("doc_id")))
    out = Counter(x["doc_id"] for x in corpus_pipeline.source_mix(spark, df, "").collect())
    assert set(out) == {0, 1, 2, 3, None} and out[None] in (2, 3, 4)


def test_pipeline_tells_rows_apart_without_their_ids(spark):
    r = random.Random(12)
    a, b, c, d = (" ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(60)) for _ in range(4))
    rows = [(None, a), (None, a), (None, b), (5, b + " end"), (7, c), (7, d), (7, d), (8, None), (8, None), (None, None), (None, " ")]
    df = spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in rows], DOC)
    kept = Counter((x["doc_id"], x["text"]) for x in corpus_pipeline.near_duplicates(spark, df, "").collect())
    assert kept == Counter([(None, a), (5, b + " end"), (7, c), (7, d), (8, None), (8, None), (None, None), (None, " ")])


@pytest.mark.parametrize("same", [False, True])
def test_pipeline_mixes_each_row_by_its_own_words(spark, same):
    """A source of null ids gets no more than its target; sources a, b, c have targets by weights 5, 2, 1."""
    rows = [(None, f"{'w' if same else i} " * 20, "en", "abc"[i % 3], 40) for i in range(90)]
    df = spark.createDataFrame(rows, DOC)
    want = {x["source"]: x["target"] for x in mixing.mix(df).collect()}
    got = Counter(x["source"] for x in corpus_pipeline.source_mix(spark, df, "").collect())
    assert all(abs(20 * got[s] - t) <= 20 for s, t in want.items())


def test_pipeline_counts_characters_of_clean_texts(spark):
    texts = [None, "", "plain words", "a password=abcdefgh12 b"]
    df = docs(spark, texts)
    out = {x["doc_id"]: (x["text"], x["n_chars"]) for x in corpus_pipeline.secret_scan(spark, df, "").collect()}
    assert out[0] == (None, 0) and out[1] == ("", 0) and out[2] == (texts[2], len(texts[2]))
    assert "abcdefgh12" not in out[3][0] and out[3][1] == len(out[3][0])
