import pytest
from pyspark.sql import functions as F

from sluicegate.functions.rules import Compiler
from sluicegate.operators import filter
from sluicegate.plans.analysis import compile_rules, cost, ordered
from sluicegate.plans.grammar import RuleError, parse

DOC = (
    '{"n":5,"s":"5","z":"5.0","t":true,"u":null,"l":"DEBUG","a":["abc",5,null],"o":{"k":1},"ip":"10.1.2.3","e":1e3,"@timestamp":"x","a-b":1,'
    '"v6":"2001:db8::1","nest":[["deep"]],"net":"10.0.0.0/8","nets":["10.0.0.0/8","192.168.0.0/16"],"badnets":["10.0.0.0/8","x"],"strs":["a","B"]}'
)
GOLDEN = {
    'n == "5.0"': True, 's == "5.0"': False, 't == "true"': False, "u == null": True, "missing == null": False, "missing != 1": True,
    "missing != missing": True, '"10" > "9"': True, "missing < 1": False, "u < 1": False, "a < 1": False, 't < "z"': True, "exists(u)": True,
    "isNull(u)": True, "isNull(missing)": False, "exists(lower(missing))": True, "lower(missing) == null": True, "!s": True, "!missing": True, "s": False, "t": True,
    'contains(a, "ab")': False, 'contains(a, "abc")': True, 'contains(a, "5")': True, 'containsIgnoreCase(a, "AB")': True, 'containsAny(a, ["ab"])': True,
    "in(a, [5])": True, 'in(n, ["5"])': True, "in(n, [])": False, 'a == "abc"': False, "o == o": False, 'equalsIgnoreCase(l, ["info","debug"])': True,
    'matchesRegex(l, "BUG$")': True, 'contains(e, "1000")': True, 'cidrContains(ip, "10.0.0.0/8")': True, 'isIpv4("010.0.0.1")': True,
    'isIpv4("256.1.1.1")': False, 'isIpv6("::ffff:1.2.3.4")': False, "a.b == 1": False, '@timestamp == "x"': True, "isIpv6(v6)": True, "isIp(ip)": True,
    'cidrContains(v6, "2001:db8::/32")': True, 'cidrContains(v6, "2001:db9::/32")': False, 'isIpv6("1::2::3")': False, 'isIpv6("::1.2.3.4")': True,
    'isIpv6("1:2:3:4:5:6:7:8")': True, 'isIpv6("1:2:3:4:5:6:7")': False, 'containsIgnoreCase(nest, "DEEP")': True, "cidrContains(ip, net)": True,
    "cidrContainsAny(ip, nets)": True, "cidrContainsAny(ip, badnets)": False, 'cidrContainsAny(ip, ["1.0.0.0/8","10.0.0.0/8"])': True, "in(s, strs)": False,
    'in("a", strs)': True, 'startsWithAny(l, ["x","DE"])': True, 'endsWithAnyIgnoreCase(l, ["ug"])': True, 'upper(lower(l)) == "DEBUG"': True,
    "t == true && n >= 5 || false": True, "!t == false": True, '(s == "5") && n < 10': True, "[1,2] == 1": False, "contains([1,2,n], 5)": True, "z == 5": True,
    'endsWith("a.b", ".b")': True, "containsAny(l, s)": False, 'in("1e0", [1])': True, "e == 1000": True, "e <= 1e3": True,
}
BROKEN = ["a-b == 1", "n == 1 == 2", "n = 1", "foo(n)", "lower(n, s)", "in(n)", 'matchesRegex(s, "(")', 'cidrContains(ip, "10.0.0.0/33")', "a..b == 1",
          'event.code == "4688" && process.name in ("x")', "", '"abc', "n & s", "1e == 1"]
INVALID = ["", "[1]", "1", '{"a":1', '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}],[1', '{"a":1}}x', None]


def events(spark, raws):
    return spark.createDataFrame([("c", i, r) for i, r in enumerate(raws)], "conn_id string, sequence long, raw string")


def test_golden(spark):
    found = compile_rules({f"r{i}": t for i, t in enumerate(GOLDEN)}, max_unindexed=500)
    compiler = Compiler(found.paths)
    tests = {r.text: compiler.test(r.tree) for r in found.rules}
    df = filter._values(filter._with_doc(events(spark, [DOC]), "raw"), found.paths, " ".join(tests.values()))
    row = df.select(*[F.expr(t).alias(f"c{i}") for i, t in enumerate(tests.values())]).first()
    got = dict(zip(tests, row))
    assert {t: (x, GOLDEN[t]) for t, x in got.items() if x is not GOLDEN[t]} == {}


@pytest.mark.parametrize("text", BROKEN)
def test_compile_errors(spark, text):
    with pytest.raises(RuleError):
        filter.apply_filter(events(spark, [DOC]), {"r": text})


def test_whole_objects_only(spark):
    found = filter.apply_filter(events(spark, [*INVALID, '{"a":1}\n', '{"a":1} ']), {"r": "a == 1"}).orderBy("sequence").collect()
    assert [r.valid for r in found] == [False] * len(INVALID) + [True, True]
    assert [r.drop for r in found] == [False] * len(INVALID) + [True, True]
    kept = filter.apply_filter(events(spark, INVALID), {})
    assert kept.where("drop or evaluation_error").count() == 0


def test_policies(spark):
    e = events(spark, ['{"a":1}', "x", '{"a":2}'])
    dropped = filter.apply_filter(e, {"r": "a == 1"}, "DROP_EVENT").orderBy("sequence").collect()
    assert [(r.drop, r.rule_name) for r in dropped] == [(True, "r"), (True, "evaluation_error"), (False, None)]
    assert [r.sequence for r in filter.apply_filter(e, {"r": "a == 1"}, "CLOSE_CONNECTION").collect()] == [0]


def test_pointers_keep_text_and_filter_normalises(spark):
    e = events(spark, ['{"a":{"b":1.0},"c":"x","d":null,"f":{}}', '{"agent":{"type":"winlogbeat"},"broken":[1,2}', '{"agent":{"type":"winlogbeat"}'])
    got = filter.extract_pointers(e, ["/a/b", "/c", "/d", "/f", "/none"]).orderBy("sequence").collect()
    assert got[0].batch_values == ["1.0", "x", None, None, None]
    assert [r.valid for r in got] == [True, False, False]
    seen = filter.apply_filter(e, {"r": "c == 1"}, batch_pointers=["/a/b", "/c", "/f"]).orderBy("sequence").first()
    assert seen.batch_values == ["1", "x", None]


def test_budget(spark):
    deep = '{"a":' + "[" * 40 + "]" * 40 + "}"
    wide = '{"a":[' + ",".join(["1"] * 20_000) + "]}"
    text = '{"a":"' + "[" * 100 + '"}'
    got = filter.apply_filter(events(spark, [deep, wide, text]), {"r": "exists(a)"}).orderBy("sequence").collect()
    assert [r.evaluation_error for r in got] == [True, True, False]


def test_rule_sets():
    found = compile_rules({"b": 'x == "1" && contains(y, "z")', "a": "in(x, [1, 2]) || y == 1"}, max_unindexed=1)
    assert [r.name for r in found.rules] == ["a", "b"]
    assert [r.indexed for r in found.rules] == [False, True]
    assert [".".join(p.parts) for p in found.paths] == ["x", "y"]
    with pytest.raises(RuleError):
        compile_rules({"a": "x == 1", "b": "y == 1"}, max_rules=1)
    with pytest.raises(RuleError):
        compile_rules({"-a": "x == 1"})
    with pytest.raises(RuleError):
        compile_rules({"a": "in(x, [])"}, max_unindexed=0)
    assert [cost(t) for t in ordered(parse('matchesRegex(a, "x") && b == 1 && exists(c)')).terms] == [2, 3, 100]


def test_one_parse_per_event(spark):
    found = filter.apply_filter(events(spark, [DOC]), {f"r{i}": f'n == {i} && s == "{i}"' for i in range(20)}).where("rule_name is null")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 2


def test_one_budget_for_all_paths_of_an_event(spark):
    from sluicegate.operators import filter

    some = "[" + ",".join(["1"] * 9000) + "]"
    rows = [(1, f'{{"a":{some},"b":{some}}}'), (2, f'{{"a":{some},"b":[1]}}'), (3, '{"a":1,"b":"' + "x,:" * 9000 + '"}')]
    events = spark.createDataFrame(rows, "event_id long, raw string").selectExpr("*", "'c' as conn_id", "event_id as sequence")
    got = filter.apply_filter(events, {"r": "in(7, a) || in(7, b)"} | {"s": "a == 7"})
    assert {r.event_id: r.evaluation_error for r in got.collect()} == {1: True, 2: False, 3: False}
