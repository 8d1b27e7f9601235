"""DataFrame to DataFrame operators: cleaning, recoding, log, geography, QA and version lifecycle."""
