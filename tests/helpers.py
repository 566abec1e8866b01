"""Small fixtures: addresses, hashes and rows."""

from datetime import datetime, timedelta

T0 = datetime(2024, 1, 1)


def address(n: int) -> str:
    return f"0x{n:040x}"


def digest(n: int) -> str:
    return f"0x{n:064x}"


def hex64(n: int) -> str:
    return f"{n:064x}"


TX = ("chain_id bigint, block_number bigint, block_hash string, block_timestamp timestamp, tx_hash string, tx_index bigint, from_address string, "
      "to_address string, value_wei string, status bigint")
TRANSFER = ("chain_id bigint, block_number bigint, block_hash string, block_timestamp timestamp, tx_hash string, log_index bigint, token_address string, "
            "from_address string, to_address string, amount_raw string")


def tx(sender, recipient, block=100, index=0, value=5, status=1, h=None, seconds=0):
    to = None if recipient is None else address(recipient)
    return (1, block, digest(block), T0 + timedelta(seconds=seconds), digest(h or block * 1000 + index), index, address(sender), to, hex64(value), status)


def transfer(sender, recipient, block=100, log=0, amount=5, h=None):
    return (1, block, digest(block), T0, digest(h or block * 1000), log, address(99), address(sender), address(recipient), hex64(amount))


FUNDING = "chain_id bigint, funded_address string, funder_address string, funding_timestamp timestamp"


def funded(funder, wallet, seconds):
    return (1, address(wallet), address(funder), T0 + timedelta(seconds=seconds))


MEMBER = "chain_id bigint, cluster_id string, wallet_address string, confidence double, cluster_run_id string"


def seed(n, name="Acme", category="dex", role="router", confidence=0.9, notes=None):
    return {"chain_id": 1, "address": address(n), "entity_name": name, "entity_category": category, "contract_role": role, "source_type": "docs",
            "source_reference": "page", "confidence": confidence, "notes": notes}
