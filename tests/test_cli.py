from starloom.__main__ import main
from starloom.plans import registry


def test_list_and_unknown_query(capsys):
    assert main(["--list"]) == 0
    out = capsys.readouterr().out.split()
    assert "q01_monthly" in out and "sql_brand_places" in out
    assert out == sorted(registry.queries()) and len(out) >= 91   # queries are added, never removed
    assert main(["no_such_query"]) == 2
    assert main([]) == 2
