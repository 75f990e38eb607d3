"""Report operators: label recoding, reshaping, snapshots, benchmarks, peers,
periods, publishing, plus the generic relational blocks they share."""
