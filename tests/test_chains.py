"""Token chains, attempts out of landed pages, and failures that a later landing clears."""

import datetime as dt
import random

from dcflow.operators.chains import page_attempts, ranked_pages, token_chains
from dcflow.operators.ledger import page_ledger, resolve_attempts
from dcflow.operators.numbering import running_sum, sliced
from dcflow.sources.pages import parse_pages

T0 = dt.datetime(2024, 6, 1)
RECORD = "<record><header><identifier>k{}</identifier><datestamp>2024-01-01</datestamp></header></record>"


def landed(spark, rows):
    """rows: (path, seconds, echo, records or error code, token or None, list size or None)"""
    out = []
    for path, at, echo, n, token, size in rows:
        tok = "" if token is None else f"<resumptionToken{'' if size is None else f' completeListSize={chr(34)}{size}{chr(34)}'}>{token}</resumptionToken>"
        body = f'<error code="{n}">e</error>' if isinstance(n, str) else f"<ListRecords>{''.join(RECORD.format(i) for i in range(n))}{tok}</ListRecords>"
        value = "<OAI-PMH" if n == "cut" else f"<OAI-PMH><responseDate>x</responseDate><request verb='ListRecords' {echo}>u</request>{body}</OAI-PMH>"
        out.append((path, T0 + dt.timedelta(seconds=at), value))
    random.Random(1).shuffle(out)
    return parse_pages(spark.createDataFrame(out, "path string, landed_at timestamp, value string"))


def test_chains_of_every_length_in_any_order(spark):
    rows = [("a0", 9, "set='a'", 2, "x 1", 5), ("a1", 1, "resumptionToken='x 1'", 2, "x2", None), ("a2", 5, "resumptionToken='x2'", 1, "", None),
            ("b0", 0, "set='b'", 3, "&lt;y+1&gt;", 9), ("c5", 0, "resumptionToken='z5'", 1, "z6", 7), ("c6", 1, "resumptionToken='z6'", 4, None, None),
            ("d0", 0, "set='d'", "noRecordsMatch", None, None), ("e0", 0, "set='e' from='2024-01-01'", "badArgument", None, None),
            ("l1", 0, "resumptionToken='loop2'", 1, "loop1", None), ("l2", 0, "resumptionToken='loop1'", 1, "loop2", None)]
    rows += [(f"n{i:03d}", -i, "set='n'" if not i else f"resumptionToken='n{i}'", 1, f"n{i + 1}" if i < 99 else "", 100) for i in range(100)]
    rows += [("a1-again", 50, "resumptionToken='x 1'", "badResumptionToken", None, None), ("a2-old", -50, "resumptionToken='x2'", 9, "gone", None)]
    pages = landed(spark, rows)
    got = {r["head"]: r for r in token_chains(pages, "https://s/oai").collect()}
    lists = {k: (r.n_pages, r.n_records, r.complete_list_size, r.complete, r.missing, r.orphan, r.resume_url) for k, r in got.items()}
    name = lambda s, f="{}": f'list:{{"v":"{s}"}}{f}{{}}'
    assert lists == {
        name("a"): (3, 5, 5, True, 0, False, None),
        name("b"): (1, 3, 9, False, 6, False, "https://s/oai?verb=ListRecords&resumptionToken=%3Cy%2B1%3E"),
        "token:z5": (2, 5, 7, True, 2, True, None),
        name("d"): (1, 0, None, True, None, False, None),
        name("e", '{"v":"2024-01-01"}'): (1, 0, None, False, None, False, None),
        name("n"): (100, 100, 100, True, 0, False, None)}
    places = {r.path: (r.head, r.place, r.answered) for r in ranked_pages(pages).where("NOT circular").collect()}
    assert [places[f"n{i:03d}"][1] for i in range(100)] == list(range(100))
    assert places["b0"][2] is False and places["a0"][2] is True and places["a2"][2] is None
    assert sorted(r.path for r in ranked_pages(pages).where("circular").collect()) == ["l1", "l2"]


def test_attempts_end_with_success_or_silence(spark):
    rows = [("1", 0, "set='a'", "badArgument", None, None), ("2", 5, "set='a'", "badArgument", None, None), ("3", 9, "set='a'", 1, None, None),
            ("4", 20, "set='a'", 1, None, None), ("5", 30, "set='a'", "badArgument", None, None), ("6", 30 + 3601, "set='a'", "noRecordsMatch", None, None),
            ("7", 0, "set='b'", "cut", None, None), ("8", 1, "set='b'", 1, None, None)]
    log = page_attempts(landed(spark, rows))
    got = {(r["request"][:12], r["request_id"].rsplit("#")[-1], r["attempt"]): r["status"] for r in log.collect()}
    assert got == {('list:{"v":"a', "1", 1): 503, ('list:{"v":"a', "1", 2): 503, ('list:{"v":"a', "1", 3): 200, ('list:{"v":"a', "2", 1): 200,
                   ('list:{"v":"a', "3", 1): 503, ('list:{"v":"a', "4", 1): 200, ("page:7", "1", 1): 502, ('list:{"v":"b', "1", 1): 200}
    done = {r["request_id"].rsplit("#")[-1]: (r["succeeded"], r["attempts_used"]) for r in resolve_attempts(log).where("request_id LIKE '%\"a\"%'").collect()}
    assert done == {"1": (True, 3), "2": (True, 1), "3": (False, 1), "4": (True, 1)}


def test_a_later_good_landing_clears_a_failure(spark):
    rows = [("1", 0, "set='a'", "badArgument", None, None), ("2", 5, "set='a'", 2, None, None), ("3", 0, "set='b'", 2, None, None),
            ("4", 5, "set='b'", "badArgument", None, None), ("5", 0, "resumptionToken='t'", "badArgument", None, None), ("6", 1, "resumptionToken='t'", 1, None, None)]
    led = {(r.set_spec, r.page): r.failed for r in page_ledger(landed(spark, rows)).collect()}
    assert led == {("a", None): False, ("b", None): True, (None, "token:t"): False}


def test_running_sum_equals_a_plain_one(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice("aaaab"), i, rnd.randint(-3, 9)) for i in range(500)] + [(None, i, 1) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, i long, x int").repartition(7)
    want, total = {}, {}
    for g, i, x in sorted(rows, key=lambda r: r[1]):
        total[g] = total.get(g, 0) + x
        want[g, i] = total[g]
    got = running_sum(sliced(df, ["g"], ["i"], 5), ["g"], "x", "s")
    assert {(r.g, r.i): r.s for r in got.collect()} == want
