"""visfold."""
