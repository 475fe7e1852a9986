"""Account-level behaviour analytics on transaction ledgers, as Spark DataFrame operators."""
