import os

import pytest

from ledgerline.catalog import features
from ledgerline.functions.agent_patterns import AgentPattern, load_patterns, parse_by_patterns

CHROME = "AppleWebKit/537.36 (KHTML, like Gecko) Chrome/106.0.0.0"
CASES = {
    "Mozilla/5.0 (Linux; Android 7.0; Nexus 6 Build/NBD90Z) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/53.0.2785.124 Mobile Safari/537.36": ("Chrome Mobile", "53.0.2785", "Android", "7.0", "Nexus 6", "Generic_Android", "Nexus 6"),
    "Mozilla/5.0 (Linux; Android 9; S20_EEA Build/PPR1.180610.011; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/95.0.4638.74 Safari/537.36": ("Chrome Mobile WebView", "95.0.4638", "Android", "9", "S20_EEA", "Generic_Android_Tablet", "S20_EEA"),
    f"Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) {CHROME} Safari/537.36": ("Chrome", "106.0.0", "Mac OS X", "10.15.7", "Mac", "Apple", "Mac"),
    f"Mozilla/5.0 (Windows NT 6.3; Win64; x64) {CHROME} Safari/537.36 Edg/106.0.1370.34": ("Edge", "106.0.1370", "Windows", "8.1", "Other", None, None),
    f"Mozilla/5.0 (Windows NT 10.0) {CHROME} Electron/23.2.0 Desktop/5.3.1 Safari/537.36": ("Electron", "23.2.0", "Windows", "10", "Other", None, None),
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/16.2 Mobile/15E148 Safari/604.1": ("Mobile Safari", "16.2", "iOS", "16.2", "iPhone", "Apple", "iPhone"),
    "Mozilla/5.0 (iPad; CPU OS 15_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) CriOS/96.0.4664 Mobile/15E148 Safari/604.1": ("Chrome Mobile iOS", "96.0.4664", "iOS", "15.1", "iPad", "Apple", "iPad"),
    "Mozilla/5.0 (Linux; Android 13; SM-S911B) AppleWebKit/537.36 (KHTML, like Gecko) SamsungBrowser/20.0 Chrome/106.0.5249.126 Mobile Safari/537.36": ("Samsung Internet", "20.0", "Android", "13", "Samsung SM-S911B", "Samsung", "SM-S911B"),
    "Mozilla/5.0 (Android 13; Mobile; rv:109.0) Gecko/109.0 Firefox/114.0": ("Firefox Mobile", "114.0", "Android", "13", "Generic Smartphone", "Generic", "Smartphone"),
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/118.0": ("Firefox", "118.0", "Ubuntu", None, "Other", None, None),
    "Mozilla/5.0 (Windows NT 6.1; WOW64; Trident/7.0; rv:11.0) like Gecko": ("IE", "11.0", "Windows", "7", "Other", None, None),
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)": ("Googlebot", "2.1", "Other", None, "Spider", "Spider", "Desktop"),
    "curl/8.1.2": ("curl", "8.1.2", "Other", None, "Other", None, None),
    "Go-http-client/1.1": ("Go-http-client", "1.1", "Other", None, "Other", None, None),
    "": ("Other", None, "Other", None, "Other", None, None),
    "nothing known 1.2": ("Other", None, "Other", None, "Other", None, None),
}


def joined(*parts):
    return ".".join(p for p in parts if p is not None) or None


def parsed(spark, texts, patterns):
    df = parse_by_patterns(spark.createDataFrame([(t,) for t in texts], "ua string"), "ua", patterns)
    return {
        r["ua"]: (
            r["browser_family"], joined(*(r[f"browser_version_{p}"] for p in ("major", "minor", "patch"))),
            r["os_family"], joined(*(r[f"os_version_{p}"] for p in ("major", "minor", "patch", "patch_minor"))), r["device_family"], r["device_brand"], r["device_model"],
        )
        for r in df.collect()
    }


def test_known_agents(spark):
    patterns = load_patterns(features.AGENT_SEED)
    assert len(patterns) >= 150
    assert parsed(spark, [*CASES, *CASES, None], patterns) == CASES


def test_many_versions_of_one_agent(spark):
    text = "Mozilla/5.0 (Linux; Android {}.0; Nexus 6 Build/NBD90Z) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/53.0.2785.124 Mobile Safari/537.36"
    out = parsed(spark, [text.format(i) for i in range(1, 2000)], load_patterns(features.AGENT_SEED))
    assert {t: v[3] for t, v in out.items()} == {text.format(i): f"{i}.0" for i in range(1, 2000)}


def test_first_pattern_of_the_table_wins(spark):
    both = [AgentPattern(2, "browser", "a", "A/<v>", "second"), AgentPattern(1, "browser", "b", "B", "first", "7")]
    assert parsed(spark, ["A/1.5 B", "A/1.5", "long " * 20_000 + "B"], both) == {
        "A/1.5 B": ("first", "7", "Other", None, "Other", None, None), "A/1.5": ("second", "1.5", "Other", None, "Other", None, None),
        "long " * 20_000 + "B": ("first", "7", "Other", None, "Other", None, None),
    }


def test_no_rows(spark):
    assert parsed(spark, [None], load_patterns(features.AGENT_SEED)) == {}


def test_one_shuffle(spark):
    df = parse_by_patterns(spark.range(10).selectExpr("cast(id as string) AS ua"), "ua", load_patterns(features.AGENT_SEED))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_faulty_pattern_is_refused(spark, tmp_path):
    path = os.path.join(tmp_path, "patterns.csv")
    with open(path, "w") as f:
        f.write("position,kind,word,pattern,family,version,brand,model\n1,browser,Not Small,x,y,,,\n")
    with pytest.raises(ValueError):
        load_patterns(path)
