"""Plan shapes shared by operators, and the end-to-end flows."""
