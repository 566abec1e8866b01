"""DataFrame operators, from resolved state to evaluated snapshots."""
