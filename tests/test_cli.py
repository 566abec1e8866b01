import pytest

from walletweave import cli
from walletweave.sources.seeds import HEADER

from .helpers import address


def test_commands(spark, tmp_path):
    (tmp_path / "s.csv").write_text(",".join(HEADER) + f"\n1,{address(1)},Acme,dex,router,docs,page,0.5,\n")
    base = ["--warehouse", f"file://{tmp_path}/w"]
    parse = cli.parser().parse_args
    assert cli.run(spark, parse([*base, "health"])) == {"healthy": True}
    got = cli.run(spark, parse([*base, "label", "--chain-id", "1", "--seeds", str(tmp_path / "s.csv")]))
    assert (got["entity_count"], got["direct_label_count"], got["propagated_label_count"]) == (1, 3, 0)
    empty = cli.run(spark, parse([*base, "cluster", "--chain-id", "1", "--from-block", "0", "--to-block", "5"]))
    assert empty["wallet_count"] == 0
    with pytest.raises(SystemExit):
        parse([*base, "cluster", "--chain-id", "1"])
