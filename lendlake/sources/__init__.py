"""Tables: schemas, reading, writing, keyed updates, and the portfolio mapping."""
