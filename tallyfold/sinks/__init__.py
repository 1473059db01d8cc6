"""Writers; the only functions here with side effects."""
