"""Reading landed files, writing tables, and the ledger of finished dates."""
