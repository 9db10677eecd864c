"""Scans and language identification against the plain patterns, planted cases and held-out texts."""

import base64
import gzip
import hashlib
import random
import re
import textwrap

import pytest

from gaugelake.llm import language, licenses, private_data, secrets

PII = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_pii(text):
    out = []
    for kind, pattern in enumerate(PII):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == 2 and 12 <= len(digits) <= 19 and private_data.luhn(digits)
                    or kind == 3 and 9 <= len(digits) <= 15):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_of_private_data():
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice("a1.@+- 0(4)9é\n") for _ in range(rng.randint(0, 40)))
        assert private_data.base_spans(text) == plain_pii(text)
    assert private_data.base_spans("card 4111 1111-1111 1111.") == [(5, 2, 24)]


def test_private_data_added(spark):
    rng = random.Random(2)
    made = []
    for i in range(240):
        words = [rng.choice("we were at home and the two of them came".split()) for _ in range(14)]
        kind, digits = i % 4, [rng.randrange(10) for _ in range(10)]
        d = "".join(map(str, digits))
        words[7] = ["anna" + d[:2] + "@mail" + d[3] + ".example.com", f"{d[:2]}.{d[2:4]}.{d[4:6]}.{d[6:8]}",
                    "4111 1111 1111 1111", f"+1 ({d[:3]}) 555-{d[3:7]}"][kind]
        made.append((i, " ".join(words)))
    docs = spark.createDataFrame(made, "doc_id long, text string")
    weights = private_data.train(docs)
    planted = [("so call (743) 555-3824 now please", "phone:8:22"),
               ("mail hans [at] example [dot] com today", "email:5:32"), ("in 1999 there were 12 of 300 at home", "")]
    table = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(planted)] + [(9, None), (10, "")],
                                  "doc_id long, text string")
    got = {r.doc_id: r.spans for r in private_data.scan(table, weights).collect()}
    assert got == {**{i: s for i, (_, s) in enumerate(planted)}, 9: "", 10: ""}
    plain = {r.doc_id: r for r in private_data.scan(docs, weights).collect()}
    for i, text in made:
        spans = private_data.as_text(plain_pii(text))
        assert plain[i].base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(spans.split(",")) <= set(plain[i].spans.split(","))


def test_marginals_of_cuts():
    """The sums over cuts against all cuts of a short region."""
    import numpy as np
    lattice = private_data.Lattice("a 12 b 3")
    scores = np.random.default_rng(0).normal(size=(len(lattice.segments), len(private_data.KINDS)))

    def cuts(at):
        if at == len(lattice.tokens):
            yield []
            return
        for rest in cuts(at + 1):
            yield rest
        for k, (i, j) in enumerate(lattice.segments):
            if i == at:
                for kind in range(len(private_data.KINDS)):
                    for rest in cuts(j):
                        yield [(k, kind), *rest]

    total, marginal = 0.0, np.zeros_like(scores)
    for cut in cuts(0):
        weight = np.exp(sum(scores[k, kind] for k, kind in cut))
        total += weight
        for k, kind in cut:
            marginal[k, kind] += weight
    assert lattice.expected(scores) == pytest.approx(marginal / total)


def test_cut_of_many_entities():
    """The best cut against all cuts, and one of more entities than a small bound holds."""
    rng = random.Random(6)

    def most(worth, start):
        return max([0.0] + [w[3] + most(worth, w[1]) for w in worth if w[0] >= start])

    for _ in range(200):
        worth = sorted([(i, i + rng.randint(1, 4), rng.randrange(4), rng.random()) for i in
                        (rng.randrange(8) for _ in range(7))], key=lambda w: w[1])
        cut = private_data.best_cut(worth)
        assert all(a[1] <= b[0] for a, b in zip(cut, cut[1:], strict=False))
        value = {w[:3]: w[3] for w in sorted(worth, key=lambda w: w[3])}
        assert sum(value[c] for c in cut) == pytest.approx(most(worth, 0))
    many = [(i, i + 1, 3, 1.0) for i in range(0, 80, 2)]
    assert private_data.best_cut(many) == [w[:3] for w in many]


@pytest.fixture(scope="module")
def weights(spark):
    """The field, fitted on plain values between words."""
    rng = random.Random(7)
    made = []
    for i in range(240):
        words = [rng.choice("we were at home and the two of them came".split()) for _ in range(14)]
        d = "".join(str(rng.randrange(10)) for _ in range(10))
        words[7] = ["anna" + d[:2] + "@mail" + d[3] + ".example.com", f"{d[:2]}.{d[2:4]}.{d[4:6]}.{d[6:8]}",
                    "4111 1111 1111 1111", f"+1 ({d[:3]}) 555-{d[3:7]}"][i % 4]
        made.append((i, " ".join(words)))
    return private_data.train(spark.createDataFrame(made, "doc_id long, text string"))


def added(text, weights):
    return [(private_data.KINDS[kind], text[a:b])
            for a, kind, b in private_data.added_spans(text, private_data.base_spans(text), weights)]


def test_private_data_at_any_distance_from_a_cue(weights):
    for cue in ("Room 12", "We met at noon there", "ask anna@mail.example.com", "we wait at home. Then"):
        for n in range(11):
            for kind, value in (("email", "jane [at] example [dot] com"), ("phone", "(743) 555-3824")):
                text = " ".join([cue, *["word"] * n, "and", value, "now"])
                assert (kind, value) in added(text, weights), text
    numbers = [f"743.555.{i:04d}" for i in range(3824, 3864)]
    assert added(",".join(numbers), weights) == [("phone", n) for n in numbers]


def test_regions_hold_every_candidate():
    rng = random.Random(8)
    for _ in range(400):
        text = "".join(rng.choice(["word ", "at ", "12", "a.b ", "@", "\n", " ", "-", "\t", "[at]", "dot ", "longer "])
                       for _ in range(rng.randint(0, 120)))

        def segments(lo, hi, text=text):
            tokens = private_data.tokens_of(text, lo, hi)
            return [(tokens[i][0], tokens[j - 1][1]) for i, j in private_data.candidates(text, tokens)]

        regions = private_data.regions(text)
        assert all(a[1] <= b[0] for a, b in zip(regions, regions[1:], strict=False))
        assert sorted(s for r in regions for s in segments(*r)) == sorted(segments(0, len(text)))


def test_private_data_of_many_tokens(weights):
    for value in ("john.smith [at] mail [dot] example [dot] com", "anna12 [at] mail3 [dot] example [dot] com",
                  "a.b-c_d.e (at) f [dot] " + " [dot] ".join("ghijklmnopqrstuvw") + " [dot] org"):
        assert ("email", value) in added(f"mail {value} today", weights), value


def test_labelled_spans_are_learned_from_or_counted(caplog):
    for value in ("anna12 [at] mail3 [dot] example [dot] com", "a.b-c_d.e+f@g.h.i.j.k.l.m.example.com"):
        assert private_data.Lattice(f"to {value} now").gold([(3, 0, 3 + len(value))]) is not None
    number = "-".join("4" * 16)
    private_data.fit([(number, [(0, 2, len(number))])])
    assert "1 of 1 labelled spans" in caplog.text


def test_private_data_of_odd_tables(with_repeats, empty):
    assert private_data.scan(empty, private_data.train(empty)).collect() == []
    assert private_data.scan(with_repeats, private_data.train(with_repeats)).count() == with_repeats.count()


SECRET = [r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
          r"AKIA[A-Z0-9]+", r"[0-9a-f]+"]


def plain_secrets(text):
    out = []
    for kind, pattern in enumerate(SECRET):
        for m in re.finditer(pattern, text):
            if len(m[2] if kind == 0 else m[0]) >= (6, 20, 24)[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_of_secrets():
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice(["token", "API_KEY", "apikey", "=", ": ", '"', "abc123", "AKIA", "AKIAXYZ0", "deadbeef",
                                   " ", "Password", "\n", "é"]) for _ in range(rng.randint(0, 12)))
        assert secrets.base_spans(text) == plain_secrets(text)


def wrap(data, how):
    return {"base64": base64.b64encode(data).decode(),
            "url": "".join(f"%{b:02X}" for b in data),
            "unicode": "".join(f"\\u{b:04x}" for b in data),
            "gzip": base64.b64encode(gzip.compress(data)).decode()}[how]


@pytest.mark.parametrize("how", [["base64"], ["url"], ["unicode"], ["gzip"], ["url", "base64"],
                                 ["base64", "gzip", "url"], ["unicode", "base64", "base64"]])
def test_layers(how):
    inner = 'password = "hunter2hunter2"'
    for h in how:
        inner = wrap(inner.encode(), h)
    text = f"see {inner} there"
    base, spans = secrets.all_spans(text)
    assert (4, 0, 4 + len(inner)) in spans and set(base) <= set(spans)
    assert secrets.redacted(text) == f"see {secrets.REPLACEMENT} there"


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
@pytest.mark.parametrize("width", [64, 76])
def test_wrapped_base64(pack, width):
    lines = " ".join(f"{hashlib.sha1(b'%d' % i).hexdigest()[:20]} words" for i in range(12))
    code = base64.b64encode(pack((lines + ' password = "hunter2hunter2" ' + lines).encode())).decode()
    wrapped = "\n".join(code[i:i + width] for i in range(0, len(code), width))
    for before, after in (("see:\n", "\nthere"), ("", ""), ("data: ", "\n\nMore words.")):
        spans = secrets.all_spans(before + wrapped + after)[1]
        assert any(kind == 0 and a <= len(before) and b >= len(before + wrapped.rstrip("=")) for a, kind, b in spans)


def test_encoded_parts_within_runs():
    code = base64.b64encode(b'password = "hunter2hunter2"').decode()
    packed = gzip.compress(b"token=abcdefgh12345")
    for text in (f"https://h/api/v1/{code}", f"/a-b_c/{code}", f"/api/v1/{code.rstrip('=')}/more",
                 f"/api/v1/{base64.b64encode(packed).decode()}", "https://h/?q=caf%E9&x=token%3Dabcdefgh12345",
                 "".join(f"%{b:02X}" for b in packed), "".join(f"\\x{b:02x}" for b in packed)):
        assert any(kind == 0 for _, kind, _ in secrets.all_spans(text)[1]), text


def test_large_and_joined_compressed_parts():
    line = "a line of the log, é and more of it.\n"
    secret = "token=abcdefgh12345\n"
    for data in (gzip.compress((line * 500_000 + secret).encode()),
                 gzip.compress((secret + "é" * 9_000_000).encode()),
                 gzip.compress(line.encode()) + gzip.compress(secret.encode()),
                 gzip.compress((line + secret[:9]).encode()) + gzip.compress((secret[9:] + line).encode())):
        code = base64.b64encode(data).decode()
        assert (4, 0, 4 + len(code)) in secrets.all_spans(f"see {code} there")[1]


def test_pieces_of_compressed_parts_hold_every_match(monkeypatch):
    monkeypatch.setattr(secrets, "CHUNK", 64)
    rng = random.Random(9)
    inner = base64.b64encode(b"token=abcdefgh12345 " * 12).decode()
    wrapped = "\n".join(inner[i:i + 64] for i in range(0, len(inner), 64))
    for _ in range(60):
        text = "".join(rng.choice(["one line, done.\n", "password = \"hunter2hunter2\"", " é ", "AKIA" + "Z" * 20, "\n",
                                   wrapped + "\n", "ab" * 20]) for _ in range(30))
        pieces = list(secrets._inflated(gzip.compress(text.encode())))
        assert "".join(pieces) == text

        def found(t):
            return [t[a:b] for a, _, b in secrets.all_spans(t)[1]]

        assert sorted(x for piece in pieces for x in found(piece)) == sorted(found(text))


def test_clean_text_has_no_secret():
    assert secrets.all_spans("100%25 of internationalisation costs %%% more" * 3) == ([], [])


def test_secrets_of_odd_tables(docs, with_repeats, empty):
    assert secrets.scan(empty).collect() == []
    assert secrets.scan(with_repeats).count() == with_repeats.count()
    kept = secrets.redact(with_repeats)
    assert kept.schema.names == with_repeats.schema.names and kept.count() == with_repeats.count()


def test_licences():
    mit = (licenses.SENTENCES["mit-grant"] + ":\n\n" + licenses.SENTENCES["mit-notice"]
           + "\n\n" + licenses.SENTENCES["as-is"])
    assert [m[0] for m in licenses.licences(f"Intro.\n{mit}\nMore.")] == ["MIT"]
    text = "Some words. All rights reserved.\nReleased under the\tMIT License."
    assert [(n, text[a:b]) for n, a, b in licenses.licences(text)] == [
        ("Proprietary", "All rights reserved."), ("MIT", "Released under the\tMIT License.")]
    bsd = " ".join(licenses.SENTENCES[k] + ":" * (k == "bsd-grant") for k in ("bsd-grant", "bsd-source", "bsd-binary"))
    assert [m[0] for m in licenses.licences(bsd)] == ["BSD-2-Clause"]
    assert licenses.licences("The rights of others are reserved for all.") == []


@pytest.mark.parametrize("width", [16, 24, 40, 72])
@pytest.mark.parametrize("sign", ["", " * ", "# ", "// "])
def test_wrapped_licences(width, sign):
    """Notices in narrow columns and comment boxes, with lines of a sign alone."""
    def box(*names):
        lines = [line for n in names for line in [*textwrap.wrap(
            licenses.SENTENCES[n] + ":" * n.endswith("grant"), width, break_on_hyphens=False), ""]]
        return "\n".join(sign + line for line in lines)

    assert [m[0] for m in licenses.licences(box("mit-grant", "mit-notice", "as-is"))] == ["MIT"]
    bsd = ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")
    assert [m[0] for m in licenses.licences(box(*bsd))] == ["BSD-3-Clause"]
    other = "\n".join(["some line of the holders without an end"] * 12)  # one sentence
    text = f"{box('apache-head')}\n{other}\n\n{box('reserved')}\n{box('apache-use')}"
    assert {m[0] for m in licenses.licences(text)} == {"Apache-2.0", "Proprietary"}


def test_licences_of_odd_tables(with_repeats, empty):
    assert licenses.scan(empty).collect() == []
    assert licenses.scan(with_repeats).count() == with_repeats.count()


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = language.predict(docs, language.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 30 and (held.lang_pred == held.lang).mean() > 0.9
    assert got.score.between(0, 1).all()


def test_language_tables_equal_the_network():
    import numpy as np
    network = language.Network(["a", "b", "c"])
    x = np.random.default_rng(1).integers(0, 256, (7, language.WINDOW), dtype=np.uint8)
    _, _, hidden = network.forward(x)
    assert language.Tables(network).probabilities(x) == pytest.approx(
        language._softmax(hidden @ network.out + network.out_bias), abs=1e-5)


def test_language_of_odd_tables(docs, with_repeats, empty):
    assert language.predict(empty, language.train(empty)).collect() == []
    got = language.predict(with_repeats, language.train(with_repeats)).collect()
    assert len(got) == with_repeats.count()
    blank = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert blank[0] == blank[3] == blank[6] == ("und", 0.0)
    assert all(r.held_out is False for r in got if r.doc_id is None)
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}
