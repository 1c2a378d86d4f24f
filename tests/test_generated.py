import random

import pytest

from phonolake.operators import generated as ops

ACCEPT = {"parse": lambda v: 0 < v <= 4096, "compat": lambda v: v > 0, "strict": lambda v: 0 <= v <= 4095}


def token(number):
    return f"<custom_token_{number}>"


def stream(rng, n, faults=0.2):
    """Texts of a mostly well-formed generation."""
    out, good = [], 0
    for _ in range(n):
        roll = rng.random()
        if roll < faults / 2:
            out.append("noise")
        elif roll < faults:
            out.append(token(rng.randrange(30000)))
        else:
            out.append(token(10 + (good % 7) * 4096 + rng.randrange(1, 4096)))
            good += 1
    return out


def slow_extract(texts, mode):
    out = []
    for seq, text in enumerate(texts):
        if not text.startswith("<custom_token_"):
            continue
        value = int(text[14:-1]) - 10 - (len(out) % 7) * 4096
        if ACCEPT[mode](value):
            out.append((seq, len(out), len(out) % 7, value))
    return out


def slow_windows(codes):
    values = [c[3] for c in codes]
    ends = [e for e in range(28, len(values) + 1, 7)]
    return [(e, values[e - 28 : e]) for e in ends if all(0 <= v <= 4096 for v in values[e - 28 : e])]


@pytest.fixture(scope="module")
def requests():
    rng = random.Random(11)
    sizes = {1: 300, 2: 0, 3: 1, 4: 64, 5: 8, 6: 27, 7: 28, 8: 65}
    out = {r: stream(rng, n) for r, n in sizes.items()}
    out[9] = stream(rng, 90, faults=0)
    out[10] = [token(10)] + stream(rng, 40, faults=0)
    out[11] = ["noise"] * 5
    return out


def events(spark, requests):
    rows = [(r, i, t) for r, texts in requests.items() for i, t in enumerate(texts)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "request_id long, seq long, text string")


@pytest.mark.parametrize("mode", list(ACCEPT))
@pytest.mark.parametrize("width", [8, 512])
def test_extract_codes(spark, requests, mode, width):
    """With width 8 the longest request spans several blocks on both levels."""
    got = {}
    for r in ops.extract_codes(events(spark, requests), mode, width).collect():
        got.setdefault(r["request_id"], []).append((r["seq"], r["idx"], r["slot"], r["code"]))
    for request, texts in requests.items():
        assert sorted(got.get(request, [])) == slow_extract(texts, mode), request


@pytest.mark.parametrize("mode", list(ACCEPT))
@pytest.mark.parametrize("width", [1, 8, 512])
def test_extract_codes_with_gaps_and_repeats(spark, requests, mode, width):
    """Any events may be missing, whole blocks too, and any may come again, also with another text."""
    rng = random.Random(5)
    rows, left = [], {}
    for request, texts in requests.items():
        gone = set(range(20, 45)) | {i for i in range(len(texts)) if rng.random() < 0.1}
        left[request] = [(i, t) for i, t in enumerate(texts) if i not in gone]
        rows += [(request, i, t) for i, t in left[request]]
        rows += [(request, i, rng.choice([t, "noise"])) for i, t in left[request] if rng.random() < 0.3]
    rng.shuffle(rows)
    got = {}
    df = spark.createDataFrame(rows, "request_id long, seq long, text string")
    for r in ops.extract_codes(df, mode, width).collect():
        got.setdefault(r["request_id"], []).append((r["seq"], r["idx"], r["slot"], r["code"]))
    for request, kept in left.items():
        want = [(kept[seq][0], *rest) for seq, *rest in slow_extract([t for _, t in kept], mode)]
        assert sorted(got.get(request, [])) == want, request


@pytest.mark.parametrize("width", [4, 256])
def test_decode_windows(spark, requests, width):
    codes = ops.extract_codes(events(spark, requests), "compat")
    got = {}
    for r in ops.decode_windows(codes, width).collect():
        rebuilt = []
        for f in range(4):
            l1, l2 = r["l1"][2 * f : 2 * f + 2], r["l2"][4 * f : 4 * f + 4]
            rebuilt += [r["l0"][f], l1[0], l2[0], l2[1], l1[1], l2[2], l2[3]]
        got.setdefault(r["request_id"], []).append((r["token_index"], rebuilt))
        assert (r["sample_from"], r["sample_to"], r["chunk_bytes"]) == (2048, 4096, 4096)
    for request, texts in requests.items():
        assert sorted(got.get(request, [])) == slow_windows(slow_extract(texts, "compat")), request


def test_decoder_report(spark, requests):
    got = {r["request_id"]: r for r in ops.decoder_report(events(spark, requests)).collect()}
    for request, texts in requests.items():
        if not texts:
            continue
        codes = slow_extract(texts, "compat")
        windows = slow_windows(codes)
        row = got[request]
        assert row["events_seen"] == len(texts)
        assert row["invalid_events"] == texts.count("noise")
        assert row["parsed_tokens"] == len(codes)
        assert row["audio_chunks"] == len(windows) and row["audio_bytes"] == 4096 * len(windows)
        assert row["audio_chunk_sizes"] == [4096] * min(12, len(windows))
        assert row["first_audio_token_index"] == (windows[0][0] if windows else None)


def test_a_code_zero_shifts_compat_but_not_strict(spark):
    texts = [token(10 + s * 4096 + v) for s, v in enumerate([5, 0, 7, 8, 9, 10, 11])]
    df = events(spark, {1: texts})
    compat = ops.extract_codes(df, "compat").count()
    strict = [r["code"] for r in ops.extract_codes(df, "strict").orderBy("idx").collect()]
    assert strict == [5, 0, 7, 8, 9, 10, 11]
    assert [r["idx"] for r in ops.extract_codes(df, "compat").orderBy("idx").collect()] == list(range(compat))
    assert compat == len(slow_extract(texts, "compat")) == 6


def test_engine_report(spark):
    texts = ["a" * 10 * i + token(i) * i for i in range(12)]
    row = ops.engine_report(events(spark, {1: texts})).first()
    assert row["callback_count"] == 12 and row["custom_token_count"] == 11
    assert row["final_text_len"] == len(texts[-1]) and row["final_text_tail"] == texts[-1][-500:]
    samples = [(s["seq"], s["len"], s["tail"]) for s in row["stream_text_samples"]]
    assert samples == [(i, len(t), t[-120:]) for i, t in enumerate(texts[:8])]


def test_no_request_is_gathered_whole(spark, requests):
    """Every collected group is a block of a request, not the request."""
    plan = ops.extract_codes(events(spark, requests))._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate" in line and "collect_list" in line]
    assert grouped and all("block" in line or "group" in line for line in grouped)
