"""Command line entry points."""

import subprocess
import sys

from conftest import ROOT, SF001


def run(*args):
    return subprocess.run([sys.executable, "-m", "strata", *args], cwd=ROOT, capture_output=True, text=True,
                          timeout=600)


def test_list_and_query_explain():
    listed = run("list")
    assert listed.returncode == 0 and "ads_business_kpi" in listed.stdout.split()
    plan = run("--master", "local[2]", "query", "dwd_business_orders", "--sf-dir", SF001, "--explain")
    assert plan.returncode == 0 and "WindowGroupLimit" in plan.stdout and "PushedFilters" in plan.stdout
